import re

import pytest

from tests.helpers import values
from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.functions.pattern import read_pattern

PATTERNS = [
    r"^[A-Z]{3}-\d{2,4}$",
    r"\d+",
    r"(foo|ba[rz]|q)?x*",
    r"[^a-z]{4}",
    r"\w\W\s\S\D",
    r"(?:ab){2,3}c",
    r"([a-c]\d)-\1",
    r"a.{3}b",
    r"[a-f0-9]{8}(-[a-f0-9]{4}){3}",
    r"(x{0,2}y){0,40}z",
    r"",
    r"пре-[а-я]{5}",
    r"a{40}[bc]{40}",
    r"(?P<x>[a-c])-(?P=x)(?#note)\x41\u00e9\101\t",
    r"[]a-][^]a][\d\-x-z\]]",
    r"a{,2}b{2,}?c{x}d{1}|(?>e|f)++g\Z",
    r"((a)(b|c))\3\1",
    r"|x",
    r"[\b]?\.\*\\",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_generated_text_matches(spark, pattern):
    if not pattern:
        return
    for text in values(spark, 60, "STRING", regular_expr=pattern):
        assert re.fullmatch(pattern, text, re.DOTALL), (pattern, text)


def test_case_is_applied_to_general_patterns(spark):
    assert all(v == v.upper() for v in values(spark, 20, "STRING", regular_expr="[a-z]{3}x?", case_mode="upper"))


def test_variety(spark):
    found = set(values(spark, 200, "STRING", regular_expr=r"(a|b)[0-9]{2}(c|d)?"))
    assert len(found) > 120 and {v[0] for v in found} == {"a", "b"}


ASSERTIONS = [
    r"^(?=.*\d)(?=.*[A-Z])(?!.*(?:00|AA))[A-Z0-9]{4}$",
    r"(?=é|a).[b-d]?",
    r"\b[a-c]{1,2}\b[ -]\b[x-z]\B[x-z]\b",
    r"(^a|b$|c){1,3}",
    r"(?<=a)b|a(?<!b)b?|[ab]{2}(?<=ab)c",
    r"(?:(?!ab)[ab]){3}",
    r"(?:[ab](?=b|$)){2}|x\Z",
    r"a$\n?",
    r"(?!^b)[abc](?![ab]$)[abc]",
    r"(?=(?!aa)\w\w)[a-c]{3}",
]


def language(pattern, characters, longest):
    """All strings over the characters that match, by trying each."""
    found, level = [], [""]
    for _ in range(longest + 1):
        found += [text for text in level if re.fullmatch(pattern, text)]
        level = [text + char for text in level for char in characters]
    return sorted(found)


@pytest.mark.parametrize(
    "pattern, characters, longest",
    [
        (r"^(?=.*\d)(?=.*[AB])(?!.*(?:00|AA))[AB01]{1,4}$", "AB01", 5),
        (r"(^a|b$|c){1,3}", "abc", 4),
        (r"(?<=a)b|a(?<!b)b?|[ab]{2}(?<=ab)c", "abc", 4),
        (r"(?:(?!ab)[ab]){3}", "ab", 4),
        (r"(?:[ab](?=b|$)){2}|x\Z", "abx", 3),
        (r"a$\n?", "a\nb", 3),
        (r"(?!^b)[abc](?![ab]$)[abc]", "abc", 3),
        (r"(?=(?!aa)\w\w)[a-c]{3}", "abc", 4),
        (r"\b[ab]{1,2}\b[ -]\b[ab]\B[ab]\b|-\B", "ab -", 6),
        (r"(?:a|ab|b(?=a)|(?<=b)c)*?(?:x|ax\b)", "abcx", 4),
        (r"(?:\b[ab] ?){1,3}", "ab ", 6),
        (r"(?:^|a)(?:b|$)", "ab", 3),
    ],
)
def test_automaton_holds_the_whole_language_in_order(pattern, characters, longest):
    found = read_pattern(pattern, longest)
    texts = [found.unrank(i) for i in range(found.count)]
    assert [text for text in texts if len(text) <= longest] == language(pattern, characters, longest)


@pytest.mark.parametrize("pattern", ASSERTIONS)
def test_text_with_assertions_matches(spark, pattern):
    found = read_pattern(pattern)
    texts = values(spark, 80, "STRING", regular_expr=pattern)
    assert all(re.fullmatch(pattern, text) for text in texts), texts
    assert len(set(texts)) > min(20, found.count // 3)


def test_automata_of_huge_languages(spark):
    pattern = r"(?=.*\d)(?=.*[A-Z])(?=.*[a-z])(?!.*\s)[!-~]{8,24}"
    found = read_pattern(pattern)
    assert found.count > 10**47
    texts = values(spark, 400, "STRING", regular_expr=pattern)
    assert all(re.fullmatch(pattern, text) for text in texts) and len(set(texts)) == 400
    assert len({text[-1] for text in texts}) > 60 and len({text[0] for text in texts}) > 60


def test_every_string_is_as_likely(spark):
    texts = values(spark, 4000, "STRING", regular_expr=r"(?!ab)[ab]{2}|(?=x)[xy]{1,2}")
    counts = {text: texts.count(text) for text in set(texts)}
    assert set(counts) == {"aa", "ba", "bb", "x", "xx", "xy"}
    assert all(abs(n - 4000 / 6) < 130 for n in counts.values())


@pytest.mark.parametrize("pattern", [r"a(?=b)", r"^a\bb$", r"a^b", r"(?=\d)[a-z]", r"(?<=x)a", r"a\Bb\b\b(?!$)"])
def test_patterns_without_strings_are_refused(spark, pattern):
    with pytest.raises(UnsatisfiableError):
        values(spark, 5, "STRING", regular_expr=pattern)


@pytest.mark.parametrize("pattern", [r"(?i)a", r"[a-", r"(a)(?(1)b|c)", r"(a)(?!b)\1", r"(?<=\b.)a"])
def test_unsupported_patterns(spark, pattern):
    with pytest.raises(SpecError):
        values(spark, 5, "STRING", regular_expr=pattern)


def test_unique_patterns_are_refused(spark):
    with pytest.raises(SpecError):
        values(spark, 5, "STRING", regular_expr="^[A-Z]{6}$", unique=True)
