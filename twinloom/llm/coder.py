"""An adaptive context-mixing range coder for token ids, over many blocks in lockstep.

A block lists its distinct ids and codes their numbers. Three predictions are mixed:

* order 2 names the number that last followed the same two, with a confidence;
* order 1 names the one that last followed the same one, with a confidence;
* order 0 is the block's frequencies so far, brought up to date at the steps in ``REFRESH``.

The weights of orders 2 and 1 are learned for each pair of confidences from how often they were
right; order 0 shares out what remains. The mixture is one interval partition, which a range
coder with 64-bit state and 32-bit words narrows; where an interval straddles a word boundary
its larger side is taken, so nothing is ever carried into written words.

Every block starts from the same empty state. Blocks are the lanes of array operations: step i
codes the i-th id of all blocks, so the interpreter works once a step and not once an id.
"""

from __future__ import annotations

import numpy as np

#: Ids of a block; at most 8192, since a prediction and its confidence share 16 bits.
BLOCK = 4096
#: Steps before which the order-0 frequencies are brought up to date.
REFRESH = frozenset({32, 128, 512, 1536})
_TOTAL_BITS = 19
_TOTAL = 1 << _TOTAL_BITS
_ORDER0_BITS = 13
#: Frequencies that share an entry of the table in which a search for one begins: 2 to this power.
_FINE_BITS = 4
_GAIN = 7
_SLOTS = 1 << 10
_SURE = 7
#: A weight is 16 bits; the two of a state share a word, that of order 2 above.
_WEIGHT_BITS = 16
_RATE = 5
#: Lanes whose frequencies are brought up to date at once.
_STRIP = 64
_RAISE = (1 << _WEIGHT_BITS - _RATE) - 1
# Numbers that steps work with are arrays of their kind, since any other number is converted anew each time.
_ONE, _WORD, _LOW_WORD, _UNIT_BITS, _LAST = (np.array(x, np.uint64) for x in (1, 32, 0xFFFFFFFF, _TOTAL_BITS, _TOTAL - 1))
_HIGH_WORD = ~_LOW_WORD
_ONE16, _SURE_BITS, _SURE16, _SLOT, _FACTOR, _ALL16 = (np.array(x, np.uint16) for x in (1, 3, _SURE, _SLOTS - 1, 1103, 0xFFFF))
_RATE32, _WEIGHT32, _LOW_WEIGHT = (np.array(x, np.uint32) for x in (_RATE, _WEIGHT_BITS, (1 << _WEIGHT_BITS) - 1))
_DECAYED, _RAISE1, _RAISE2 = (np.array(x, np.uint32) for x in (((1 << _WEIGHT_BITS - _RATE) - 1) * 0x10001, _RAISE, _RAISE << _WEIGHT_BITS))
_ONE32, _TWO32, _TOTAL32, _SCALE = (np.array(x, np.uint32) for x in (1, 2, _TOTAL, _TOTAL_BITS - _WEIGHT_BITS))
_ORDER0, _ORDER0_LAST, _FINE, _ALL32 = (np.array(x, np.uint32) for x in (_ORDER0_BITS, (1 << _ORDER0_BITS) - 1, _FINE_BITS, (1 << 32) - 1))
_ONE64, _HALVES = np.array(1), [np.array(1 << bit) for bit in range(_FINE_BITS - 1, -1, -1)]
_NUMBERS = {
    np.int64: "i1 i2 iw place t",
    np.uint16: "entry c1 c2 k1 k2 hash state new short level16 x8 before x other mask",
    np.uint32: "weight both a2 a12 rest start end aim level u miss named1 named2",
    np.uint64: "low ahead unit moved",
    bool: "hit1 hit2 right1 far flag",
}


def _zeros(arrays: dict[str, tuple[int, type]]) -> dict[str, np.ndarray]:
    """Arrays of the given lengths and types side by side, so that they share large pages of memory."""
    starts = np.cumsum([0] + [-(-n * np.dtype(kind).itemsize // 64) * 64 for n, kind in arrays.values()]).tolist()
    room = np.zeros(starts[-1], np.uint8)
    return {
        name: room[at : at + n * np.dtype(kind).itemsize].view(kind)
        for at, (name, (n, kind)) in zip(starts, arrays.items())
    }


def table(rows: int, columns: int) -> np.ndarray:
    """A table of 16-bit numbers whose rows do not lie a power of two apart, for then a column's would share a cache line."""
    return np.zeros((rows, columns + 32), np.uint16)[:, :columns]


class _Model:
    """The predictions of all lanes; lane l has ``sizes[l]`` distinct ids.

    All steps work in the same buffers, as narrow as their numbers allow, since arrays that come and go
    and wide ones cost more than their contents.
    """

    def __init__(self, sizes: np.ndarray, search: bool):
        lanes = len(sizes)
        width = int(sizes.max(initial=1)) + (1 << _FINE_BITS)  # a search stays in its row
        self.lanes, self.width, self.sizes = lanes, width, sizes.astype(np.int64)
        lane = np.arange(lanes)
        self.row = lane * width
        self.whole = {"at0": self.row, "at2": lane * _SLOTS, "atw": lane, "atf": lane << _ORDER0_BITS - _FINE_BITS}
        kinds = {name: (lanes, kind) for kind, names in _NUMBERS.items() for name in names.split()}
        self.whole |= _zeros(kinds | {"span": (lanes, np.uint64)})
        self.whole["span"][:] = (1 << 64) - 1
        self.whole |= {f"{name}_8": self.whole[name].view(np.uint8) for name in _NUMBERS[bool].split()}
        self.first_width = 1 << _ORDER0_BITS - _FINE_BITS if search else 0
        tables = {"after1": width, "after2": _SLOTS, "order0": width, "first": self.first_width}
        tables = {name: (lanes * each, np.uint16) for name, each in tables.items()} | {"weights": (lanes * 128, np.uint32)}
        for name, table in _zeros(tables).items():
            setattr(self, name, table)
        self.unknown = np.arange(width) >= sizes[:, None]
        self.counts = (~self.unknown).astype(np.int32)
        # Numbers since the last refresh.
        self.seen, self.since = np.zeros((max(REFRESH), lanes), np.uint16), 0
        # Before anything is learned, a prediction with confidence k is right in k of k + 2 or 3 cases.
        state, full = np.arange(128), 1 << _WEIGHT_BITS
        sure2, sure1 = state % 64 // 8, state % 8
        weight2 = full * sure2 // (sure2 + 2)
        weight1 = np.where(state < 64, (full - weight2) * sure1 // (sure1 + 3), 0)
        # The weights of a state lie side by side, since most lanes are in a few of them.
        self.weights.reshape(128, lanes)[:] = (weight2 << _WEIGHT_BITS | weight1)[:, None]
        self.state_width = np.array(lanes)
        self.step, self.n = 0, -1

    def begin(self, n: int) -> None:
        """Go on with the first n lanes."""
        if n != self.n:
            self.n = n
            for name, values in self.whole.items():
                setattr(self, name, values[:n])
        if self.step in REFRESH or not self.step:
            self._refresh()
        self.step += 1
        self._predict()

    def _refresh(self) -> None:
        """Cumulative frequencies of 2^13 in which every listed id has at least one; beyond them, more."""
        for first in range(0, self.lanes, _STRIP):  # as many lanes as the cache holds
            part = slice(first, first + _STRIP)
            counts, sizes, unknown = self.counts[part], self.sizes[part], self.unknown[part]
            if self.step > self.since:
                at = self.seen[self.since : self.step, part] + (self.row[part] - self.row[first])
                found = np.bincount(at.reshape(-1), minlength=counts.size).reshape(counts.shape)
                found *= _GAIN
                counts += found
            sums = np.cumsum(counts, 1, dtype=np.int32)
            room = ((1 << _ORDER0_BITS) - sizes) / np.maximum(sums[:, -1], 1)
            starts = self.order0.reshape(self.lanes, -1)[part]
            starts[:, 0] = 0
            starts[:, 1:] = (sums[:, :-1] * room[:, None]).astype(np.uint16)
            starts += np.arange(self.width, dtype=np.uint16)
            starts[unknown] = (1 << _ORDER0_BITS) + 1
            lane = np.arange(len(sizes))
            starts[lane, sizes] = 1 << _ORDER0_BITS
            if self.first_width:
                # The last number that starts not above each multiple of 2^_FINE_BITS.
                multiple = (starts[~unknown] + np.uint16((1 << _FINE_BITS) - 1)) >> _FINE_BITS
                multiple = multiple + np.repeat(lane * (self.first_width + 1), sizes)
                found = np.bincount(multiple, minlength=len(sizes) * (self.first_width + 1)).reshape(len(sizes), -1)[:, :-1]
                fine = self.first.reshape(self.lanes, -1)[part]
                np.cumsum(found, 1, out=fine, dtype=np.uint16)
                fine -= 1
        self.since = self.step

    def _predict(self) -> None:
        np.add(self.at0, self.before, out=self.i1)
        self.hash += self.before
        self.hash &= _SLOT
        np.add(self.at2, self.hash, out=self.i2)
        entry = self.entry
        for table, index, number, sure in ((self.after1, self.i1, self.c1, self.k1), (self.after2, self.i2, self.c2, self.k2)):
            table.take(index, out=entry, mode="wrap")
            np.right_shift(entry, _SURE_BITS, out=number)
            np.bitwise_and(entry, _SURE16, out=sure)
        state = self.state
        np.equal(self.c1, self.c2, out=self.flag)
        np.left_shift(self.flag_8, _SURE_BITS, out=state)
        state += self.k2
        state <<= _SURE_BITS
        state += self.k1
        np.multiply(state, self.state_width, out=self.iw)
        self.iw += self.atw
        weight, both, a2, a12 = self.weight, self.both, self.a2, self.a12
        self.weights.take(self.iw, out=weight, mode="wrap")
        np.right_shift(weight, _RATE32, out=both)
        both &= _DECAYED
        np.subtract(weight, both, out=both)
        # A share is the weight without what it is about to lose, plus one.
        np.right_shift(both, _WEIGHT32, out=a2)
        np.bitwise_and(both, _LOW_WEIGHT, out=a12)
        a12 += a2
        a12 += _TWO32
        a2 += _ONE32
        a2 <<= _SCALE
        a12 <<= _SCALE
        np.subtract(_TOTAL32, a12, out=self.rest)

    def interval(self, place: np.ndarray) -> None:
        """Start and end of each lane's number, with ``place`` where its order-0 frequency stands.

        Masks choose between orders, since choices by flag that follow no pattern take longer.
        """
        named1, named2, miss, start, end, u = self.named1, self.named2, self.miss, self.start, self.end, self.u
        np.multiply(self.hit1_8, _ALL32, out=named1)
        np.multiply(self.hit2_8, _ALL32, out=named2)
        np.bitwise_or(named1, named2, out=miss)
        np.invert(miss, out=miss)
        self.rest &= miss
        self.order0.take(place, out=self.short, mode="wrap")
        np.multiply(self.rest, self.short, out=start)
        start >>= _ORDER0
        miss &= self.a12
        start += miss
        np.bitwise_and(named1, self.a2, out=u)
        start += u
        place += _ONE64
        self.order0.take(place, out=self.short, mode="wrap")
        np.multiply(self.rest, self.short, out=end)
        end >>= _ORDER0
        np.bitwise_xor(self.a2, self.a12, out=u)
        u &= named2
        u ^= self.a12
        end += u

    def learn(self, x: np.ndarray) -> None:
        """What the number x of each lane teaches; hit1, hit2 and right1 say who named it."""
        both, u, new, x8 = self.both, self.u, self.new, self.x8
        for named, gain in ((self.named1, _RAISE1), (self.named2, _RAISE2)):
            np.bitwise_and(named, gain, out=u)
            both += u
        self.weights[self.iw] = both
        # The last number that followed is the next one named; its confidence counts how often in a row.
        np.left_shift(x, _SURE_BITS, out=x8)
        for table, index, sure, right in ((self.after1, self.i1, self.k1, self.right1_8), (self.after2, self.i2, self.k2, self.hit2_8)):
            sure += _ONE16
            np.minimum(sure, _SURE16, out=sure)
            np.multiply(sure, right, out=new)
            new += x8
            table[index] = new
        if self.step <= len(self.seen):
            self.seen[self.step - 1, : self.n] = x
        np.multiply(self.before, _FACTOR, out=self.hash)  # of which only the lowest bits count
        np.copyto(self.before, x)

    def narrow(self) -> np.ndarray:
        """Take the interval out of low and span; the lanes that have a word to shift."""
        self.end -= self.start
        np.multiply(self.unit, self.start, out=self.moved)
        self.low += self.moved
        np.multiply(self.unit, self.end, out=self.span)
        np.less_equal(self.span, _LOW_WORD, out=self.flag)
        return np.flatnonzero(self.flag)


def _settle(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals below 2^32 cut to the larger side of a word boundary, if they straddle one."""
    last = span - _ONE
    last += low
    boundary = last & _HIGH_WORD
    cut = np.flatnonzero(boundary > low)
    if len(cut):
        middle, first = boundary[cut], low[cut]
        head, tail = middle - first, last[cut] - middle + _ONE
        upper = tail > head
        low, span = low.copy(), span.copy()
        low[cut], span[cut] = np.where(upper, middle, first), np.where(upper, tail, head)
    return low, span


def _turned(values: np.ndarray) -> np.ndarray:
    """Rows as columns, in strips of which the cache holds all lines."""
    turned = np.empty(values.shape[::-1], values.dtype)
    for a in range(0, values.shape[1], 32):
        turned[a : a + 32] = values[:, a : a + 32].T
    return turned


def _active(lengths: np.ndarray) -> np.ndarray:
    """How many lanes take part in each step; lanes are ordered by falling length."""
    return np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), "left")


def encode(numbers: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The code of each lane; ``numbers`` is lanes by steps, ``lengths`` falls."""
    lanes = len(lengths)
    model = _Model(sizes, search=False)
    steps = _turned(numbers)
    words = np.zeros((lanes, BLOCK * (_TOTAL_BITS + 1) // 32 + 8), np.uint32)
    flat_words, word_at = words.reshape(-1), np.arange(lanes) * words.shape[1]
    for n, x in zip(_active(lengths).tolist(), steps):
        model.begin(n)
        x = x[:n]
        np.equal(model.c2, x, out=model.hit2)
        np.equal(model.c1, x, out=model.right1)
        np.greater(model.right1, model.hit2, out=model.hit1)
        np.add(model.at0, x, out=model.place)
        model.interval(model.place)
        model.learn(x)
        np.right_shift(model.span, _UNIT_BITS, out=model.unit)
        due = model.narrow()
        if len(due):
            own, width = _settle(model.low[due], model.span[due])
            flat_words[word_at[due]] = own >> _WORD
            word_at[due] += 1
            model.low[due], model.span[due] = own << _WORD, width << _WORD
    # One more word names a value inside the interval; a reader takes zeros beyond the end.
    flat_words[word_at] = (model.whole["low"] + _LOW_WORD) >> _WORD
    ends = word_at + 1 - np.arange(lanes) * words.shape[1]
    return [words[lane, :end].astype("<u4").tobytes() for lane, end in enumerate(ends.tolist())]


def decode(codes: list[bytes], lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of each lane, lanes by steps; beyond a lane's length they mean nothing."""
    lanes = len(lengths)
    model = _Model(sizes, search=True)
    words = np.zeros((lanes, max((len(code) for code in codes), default=0) // 4 + 3), np.uint32)
    for lane, code in enumerate(codes):
        words[lane, : len(code) // 4] = np.frombuffer(code, "<u4")
    flat_words, word_at = words.reshape(-1), np.arange(lanes) * words.shape[1] + 2
    lane_end = np.arange(1, lanes + 1) * words.shape[1] - 1
    # How far the coded value lies above low.
    model.whole["ahead"][:] = (words[:, 0].astype(np.uint64) << _WORD) | words[:, 1]
    out = table(int(lengths.max(initial=0)), lanes)
    for step, n in enumerate(_active(lengths).tolist()):
        model.begin(n)
        np.right_shift(model.span, _UNIT_BITS, out=model.unit)
        np.floor_divide(model.ahead, model.unit, out=model.moved)
        np.minimum(model.moved, _LAST, out=model.moved)
        aim, level, place, t, x, other, mask = model.aim, model.level, model.place, model.t, model.x, model.other, model.mask
        np.copyto(aim, model.moved, casting="unsafe")
        np.less(aim, model.a2, out=model.hit2)
        np.greater_equal(aim, model.a12, out=model.far)
        # The last number whose order-0 start is not above the aim; of use in far lanes only.
        np.subtract(aim, model.a12, out=level)
        level += _ONE32
        level <<= _ORDER0
        level -= _ONE32
        level //= model.rest
        level &= _ORDER0_LAST
        np.copyto(model.level16, level, casting="unsafe")
        level >>= _FINE
        np.add(model.atf, level, out=place)
        model.first.take(place, out=model.short, mode="wrap")
        np.add(model.at0, model.short, out=place)
        for half in _HALVES:
            np.add(place, half, out=t)
            model.order0.take(t, out=model.short, mode="wrap")
            np.less_equal(model.short, model.level16, out=model.flag)
            np.multiply(model.flag_8, half, out=t)
            place += t
        np.subtract(place, model.at0, out=t)
        np.bitwise_xor(model.c1, model.c2, out=x)
        np.multiply(model.hit2_8, _ALL16, out=mask)
        x &= mask
        x ^= model.c1
        np.copyto(other, t, casting="unsafe")
        other ^= x
        np.multiply(model.far_8, _ALL16, out=mask)
        other &= mask
        x ^= other
        np.equal(model.c1, x, out=model.right1)
        np.greater(model.right1, model.hit2, out=model.hit1)
        model.interval(place)
        model.learn(x)
        np.copyto(out[step, :n], x)
        due = model.narrow()
        model.ahead -= model.moved
        if len(due):
            before = model.low[due]
            own, width = _settle(before, model.span[due])
            at = word_at[due]
            model.ahead[due] = ((model.ahead[due] - (own - before)) << _WORD) | flat_words[at]
            word_at[due] = np.minimum(at + 1, lane_end[due])
            model.low[due], model.span[due] = own << _WORD, width << _WORD
    return _turned(out)
