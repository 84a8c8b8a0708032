"""Personal data: spans by pattern, and bootstrapped extraction of further ones by their contexts.

All work is DataFrame operations. Base spans come from regular expressions and checks. They are
the seeds: the words beside a seed induce lexical patterns (the word before, the two words before,
the word before with the word after). Further instances begin at any other word with a digit or an
at sign. Such words with one space between them are a run, cut where base spans lie, and what may
begin at a word of it is, for an address, that word, and for a number the rest of the run or any
part of it that is written like a seed, or like a part of one, digit for digit.

On the graph of patterns and instances a pattern's confidence in a kind is the share of scores that
speak for the kind among the different places it was met at: seeds of other kinds and places where
nothing looks like the kind speak against it, and unseen instances that do look like it say nothing
until they are accepted. An unseen instance's score is the noisy-or of its confident patterns; what
is accepted stays so and counts with its score from the next round on. Rounds end when one accepts
nothing new. A pattern needs ``SUPPORT`` different seeds and ``CONFIDENCE``. Of added spans that
share words the one written like a seed stays, then the one of more words, of the higher score, and
the earlier one; a span goes where a better one shares a word with it.

One pass reads the texts and keeps the matches with their contexts, written once; positions are
running sums over the pieces between matches. Scores are sums, combined before each shuffle, so a
pattern such as a frequent word sends one row a task. Expressions are written without nested
backtracking: possessive repeats, and look-behinds that stop a rescan within a word.

Defined cases: a null text is empty; a null doc_id stays null; repeated rows have a result each
and count once in the graph; columns other than doc_id and text are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinloom.llm.rows import written

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENCE = 5, 0.9
#: No kind of number has more digits, and every word of a run holds one; longer runs are no number.
WORDS = 19

# Fixed forms of the base spans, with possessive repeats where that changes no match. An address
# cannot begin within a run of its characters except where the last one ended (\G).
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_LIKE = r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+"
_TWO_LAST = r"(?:(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]++[\x20\x09-\x0D]++)?(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*+[\x20\x09-\x0D]*+$"
_NEXT = r"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]*+[^\x20\x09-\x0D]*+"
_FORMS = dict(zip((*KINDS, "other"), (_EMAIL, _IP, _CARD, _PHONE, _LIKE), strict=True))
_NEEDS = {"email": "@", "phone": "+"}
_FOUND = "array<struct<kind:string,nth:int,gap:int,hit:string,left:string,right:string,glued:boolean>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right is doubled."""
    reverse = F.split(F.reverse(digits), "")
    values = F.transform(reverse, lambda d, i: (d.cast("int") * (1 + i % 2)).cast("int"))
    return F.aggregate(values, F.lit(0), lambda total, v: total + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _passes(kind: Column, text: Column) -> Column:
    digits = _digits(text)
    count = F.length(digits)
    part = r"0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
    card = F.when(count.between(16, 19), _luhn(digits)).otherwise(False)
    return (
        F.when(kind == "ip", text.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(kind == "card", card)
        .when(kind == "phone", count.between(8, 15))
        .otherwise(True)
    )


def _looks_like(kind: str, text: Column) -> Column:
    if kind == "email":
        return text.contains("@") & ~text.contains(" ")
    count = F.length(_digits(text))
    if kind == "ip":
        return (count >= 4) & ~text.contains(" ") & (F.regexp_count(text, F.lit(r"[0-9][.:_-]+(?=[0-9])")) >= 3)
    return count.between(12 if kind == "card" else 7, 19 if kind == "card" else 15) & ~text.contains("@")


def _described(kind: str, pieces: Column, hits: Column) -> Column:
    """The matches of one form, each with the two words before it and the rest of its word and the word after."""

    def around(hit: Column, i: Column) -> Column:
        none = F.lit("")
        back = [F.when(i >= n, F.get(array, i - n)).otherwise(none) for array, n in ((hits, 2), (pieces, 1), (hits, 1))]
        piece = F.get(pieces, i)
        after = F.concat(F.get(pieces, i + 1), F.coalesce(F.get(hits, i + 1), none))
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            F.length(piece).alias("gap"),
            hit.alias("hit"),
            F.regexp_extract(F.concat(*back, piece), _TWO_LAST, 0).alias("left"),
            F.regexp_extract(after, _NEXT, 0).alias("right"),
            (piece == " ").alias("glued"),
        )

    return F.transform(hits, around)


def _matches(docs: DataFrame) -> DataFrame:
    """Rows (row, doc_id, found): all matches of all forms, with the length of the text before each."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), text.alias("text"))
    digit = F.col("text").rlike("[0-9@]")
    found = []
    for kind, form in _FORMS.items():
        has = F.contains(F.col("text"), F.lit(_NEEDS[kind])) if kind in _NEEDS else digit
        docs = docs.withColumn("pieces", F.when(has, F.split("text", form, -1)))
        docs = docs.withColumn("hits", F.when(has, F.regexp_extract_all("text", F.lit(form), 0)))
        docs = docs.withColumn(kind, _described(kind, F.col("pieces"), F.col("hits"))).drop("pieces", "hits")
        found.append(F.coalesce(F.col(kind), F.array().cast(_FOUND)))
    return written(docs.select("row", "doc_id", F.concat(*found).alias("found")), "matches")


def _placed(matches: DataFrame) -> DataFrame:
    """One row a match, with its start and end in code points."""
    flat = matches.select("row", F.explode("found").alias("m")).select("row", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("hit")).over(upto)
    return flat.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))


def _free_words(placed: DataFrame, base: DataFrame) -> DataFrame:
    """Words with digits or at signs that overlap no base span."""
    words = placed.where("kind = 'other'").drop("kind", "gap").withColumn("seed", F.lit(False))
    spans = base.select("row", "start", "end", F.lit(True).alias("seed"))
    both = words.unionByName(spans, allowMissingColumns=True)
    before = Window.partitionBy("row").orderBy("start", F.desc("seed")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("start"), "seed").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("reached", F.max(F.when(F.col("seed"), F.col("end"))).over(before))
    both = both.withColumn("next", F.min(F.when(F.col("seed"), F.col("start"))).over(after))
    free = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    return both.where(~F.col("seed") & free).drop("seed", "reached", "next")


def _shape(text: Column) -> Column:
    return F.regexp_replace(text, "[0-9]", "0")


def _shapes(base: DataFrame) -> DataFrame:
    """Rows (shape, like_seeds): how numbers among the seeds are written, whole or by some of their words."""
    seeds = base.where("kind IN ('card', 'phone')").select("kind", F.split(_shape(F.col("text")), " ").alias("words")).distinct()
    first = seeds.select("kind", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("first"))
    parts = first.select("kind", "words", "first", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("first") + 1)).alias("n"))
    parts = parts.select("kind", F.array_join(F.slice("words", F.col("first"), F.col("n")), " ").alias("shape"))
    alike = F.coalesce(*(F.when(F.col("kind") == kind, _looks_like(kind, F.col("shape"))) for kind in ("card", "phone")))
    return parts.where(alike).groupBy("shape").agg(F.collect_set("kind").alias("like_seeds"))


def _unseen(words: DataFrame, shapes: DataFrame) -> DataFrame:
    """What may begin at each word: (row, nth, n, start, end, text, place, left, right, like_seed, kinds).

    ``place`` is the whole rest of the run in lower case, the same for all that may begin there; it
    has a row of its own, without kinds, if nothing there looks like any kind.
    """
    ahead = Window.partitionBy("row").orderBy("nth").rowsBetween(0, WORDS)
    follows = F.collect_list(F.struct("nth", "glued", "hit", "end", "right")).over(ahead)
    runs = words.select("row", "nth", "start", "left", follows.alias("ahead"))
    breaks = F.transform("ahead", lambda x, i: (i > 0) & ~(x["glued"] & (x["nth"] == F.col("nth") + i)))
    at = F.array_position(breaks, True)
    runs = runs.withColumn("size", F.when(at > 0, at - 1).otherwise(F.size("ahead")).cast("int"))
    runs = runs.withColumn("hits", F.slice(F.transform("ahead", lambda x: x["hit"]), F.lit(1), F.col("size")))
    runs = runs.withColumn("place", F.lower(F.array_join("hits", " ")))
    parts = runs.select("*", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("n"))
    last = F.get("ahead", F.col("n") - 1)
    parts = parts.select("row", "nth", "n", "size", "place", "start", "left", F.array_join(F.slice("hits", F.lit(1), F.col("n")), " ").alias("whole"), last["end"].alias("end"), last["right"].alias("right"))
    lead = F.length(F.regexp_extract("whole", r"""^(?:[\["'<]|\((?![^)]*\)))*+""", 0))
    trail = F.length(F.regexp_extract("whole", r"""[\])"'>.,;:!?]*+$""", 0))
    parts = parts.withColumn("start", F.col("start") + lead).withColumn("end", F.col("end") - trail)
    length = F.greatest(F.col("end") - F.col("start"), F.lit(0)).cast("int")
    parts = parts.withColumn("text", F.substring(F.col("whole"), lead + 1, length))
    loose = F.array_compact(F.array(*(F.when(_looks_like(kind, F.col("text")), F.lit(kind)) for kind in KINDS)))
    parts = parts.withColumn("loose", F.when(F.col("n") <= WORDS, loose).otherwise(F.array().cast("array<string>")))
    rest = F.col("n") == F.col("size")
    parts = parts.where(rest | (F.size("loose") > 0)).withColumn("shape", F.when(F.size("loose") > 0, _shape(F.col("text"))))
    parts = parts.join(shapes, "shape", "left")
    like_seed = F.coalesce(F.array_intersect("loose", "like_seeds"), F.array().cast("array<string>"))
    alone = F.when(rest, F.col("loose")).when(F.col("n") == 1, F.array_intersect("loose", F.array(F.lit("email"), F.lit("ip"))))
    parts = parts.withColumn("like_seed", like_seed).withColumn("kinds", F.array_union(F.coalesce(alone, F.array().cast("array<string>")), "like_seed"))
    columns = ["row", "nth", "n", "start", "end", "text", "place", "left", "right", "like_seed", "kinds"]
    return parts.where((F.size("kinds") > 0) | rest).select(columns)


def _patterns() -> Column:
    """The lexical patterns of an instance's sides."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    words = F.filter(F.split(plain(F.col("left")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    one, n = F.element_at(words, -1), F.size(words)
    follows = F.regexp_extract(plain(F.col("right")), r"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)", 1)
    return F.array_compact(
        F.array(
            F.when(n >= 1, F.concat(F.lit("1 "), one)),
            F.when(n >= 2, F.concat_ws(" ", F.lit("2"), F.element_at(words, -2), one)),
            F.when((n >= 1) & (follows != ""), F.concat_ws(" ", F.lit("r"), one, F.lit("_"), follows)),
        )
    )


def _discovered(seeds: DataFrame, unseen: DataFrame, support: int, confidence: float, rounds: int | None) -> DataFrame:
    """Rows (text, kind, score): unseen instances that confident patterns vouch for."""
    none = F.array().cast("array<string>")
    text = F.lower("text")
    seeds = seeds.select(F.explode(_patterns()).alias("pattern"), text.alias("place"), text.alias("text"), "kind", none.alias("kinds"))
    unseen = unseen.select(F.explode(_patterns()).alias("pattern"), "place", text.alias("text"), F.lit(None).cast("string").alias("kind"), "kinds")
    edges = written(seeds.unionByName(unseen).distinct(), "pattern-graph")
    # by pattern: its different places, and of these the ones without a seed where something looks like each kind
    seeded = F.max(F.col("kind").isNotNull()).alias("seeded")
    alike = [F.max((F.array_contains("kinds", k)).cast("int")).alias(k) for k in KINDS]
    places = edges.groupBy("pattern", "place").agg(seeded, *alike)
    neutral = [F.sum(F.when(F.col("seeded"), 0).otherwise(F.col(k))).alias(k) for k in KINDS]
    size = written(places.groupBy("pattern").agg(F.count("*").alias("size"), *neutral), "pattern-sizes")
    sure = edges.where("kind IS NOT NULL").select("pattern", "place", "kind", F.lit(1.0).alias("score"), F.lit(0).alias("new"))
    unseen = edges.where("size(kinds) > 0").select("pattern", "place", "text", "kinds")
    known = written(edges.limit(0).select("text", "kind", F.lit(1.0).alias("score")), "discovered")
    while rounds is None or rounds > 0:
        met = unseen.join(known, "text").where(F.array_contains("kinds", F.col("kind")))
        scored = sure.unionByName(met.select("pattern", "place", "kind", "score", F.lit(1).alias("new")))
        # an accepted place counts once, with its score, and is no longer neutral
        scored = scored.groupBy("pattern", "place", "kind").agg(F.max("score").alias("score"), F.min("new").alias("new"))
        found, accepted = F.sum("score").alias("found"), F.sum("new").alias("accepted")
        trusted = scored.groupBy("pattern", "kind").agg(found, accepted).where(F.col("found") >= support)
        unsaid = F.coalesce(*(F.when(F.col("kind") == k, F.col(k)) for k in KINDS))
        judged = F.greatest(F.col("size") - unsaid + F.col("accepted"), F.col("found"))
        trusted = trusted.join(size, "pattern").withColumn("trust", F.least(F.col("found") / judged, F.lit(0.999999)))
        trusted = written(trusted.where(F.col("trust") >= confidence).select("pattern", "kind", "trust"), "trusted-patterns")
        votes = unseen.join(trusted, "pattern").where(F.array_contains("kinds", F.col("kind")))
        votes = votes.select("text", "kind", "pattern", "trust").distinct()
        votes = votes.groupBy("text", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score"))
        best = F.max_by(F.struct("kind", "score"), F.struct("score", F.col("kind").alias("name"))).alias("best")
        new = votes.where(F.col("score") >= confidence).groupBy("text").agg(best).select("text", "best.kind", "best.score")
        new = written(new.join(known, "text", "left_anti"), "accepted")
        if new.isEmpty():
            break
        known = written(known.unionByName(new), "discovered")
        rounds = None if rounds is None else rounds - 1
    return known


def _added(unseen: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (row, kind, start, end): where accepted instances lie, without those that a better one overlaps."""
    keyed = unseen.withColumn("key", F.lower("text")).join(known.withColumnRenamed("text", "key"), "key")
    keyed = keyed.where(F.array_contains("kinds", F.col("kind")))
    like_seed = F.array_contains("like_seed", F.col("kind"))
    rank = F.struct(like_seed.alias("like_seed"), "n", "score", (-F.col("nth")).alias("early"), "kind", "start", "end")
    words = keyed.select("row", rank.alias("span"), F.explode(F.sequence(F.col("nth"), F.col("nth") + F.col("n") - 1)).alias("word"))
    best = words.groupBy("row", "word").agg(F.max("span").alias("span"))
    kept = best.groupBy("row", "span").agg(F.count("*").alias("won")).where(F.col("won") == F.col("span.n"))
    return kept.select("row", "span.kind", "span.start", "span.end")


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def personal_data(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int | None = None) -> DataFrame:
    """One row a document: (row, doc_id, n_<kind>..., base_sha256, spans, n_added).

    Counts and the hash are those of base spans; ``spans`` has all, and n_added those found by context.
    ``rounds`` bounds the rounds, 0 adds nothing; without it they go on until one adds nothing.
    """
    matches = _matches(docs)
    placed = _placed(matches)
    base = placed.where("kind <> 'other'").where(_passes(F.col("kind"), F.col("hit")))
    base = written(base.select("row", "kind", "start", "end", F.col("hit").alias("text"), "left", "right"), "base-spans")
    unseen = written(_unseen(_free_words(placed, base), _shapes(base)), "unseen")
    added = _added(unseen, _discovered(base, unseen, support, confidence, rounds))
    columns = ["row", "kind", "start", "end"]
    both = base.select(*columns, F.lit(True).alias("base")).unionByName(added.select(*columns, F.lit(False).alias("base")))
    both = both.withColumn("place", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
    spans = F.sort_array(F.collect_list(F.struct("place", "start", "end", "kind", "base")))
    listed = both.groupBy("row").agg(spans.alias("all"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    every = F.coalesce("all", F.array().cast("array<struct<place:bigint,start:bigint,end:bigint,kind:string,base:boolean>>"))
    out = matches.select("row", "doc_id").join(listed, "row", "left").withColumn("all", every)
    own = F.filter("all", lambda s: s["base"])
    counts = [F.size(F.filter(own, _is_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return out.select(
        "row",
        "doc_id",
        *counts,
        F.sha2(joined(own), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
        (F.size("all") - F.size(own)).cast("bigint").alias("n_added"),
    )
