"""Substring dedup: paragraphs by content, MinHash bands, exact Jaccard, removals by components.

Repeated passages begin and end anywhere, so a paragraph here is a run of ``PARAGRAPH`` words that begins at
an anchor: the shingle of least hash within some ``REACH`` neighbouring ones. Anchors depend on nearby words
alone, so a passage of ``PARAGRAPH + REACH - 1`` words that two documents share holds at least one paragraph that both
cut alike, and longer ones hold several, overlapping.

Bands: a paragraph's key has two rows, its anchor (the minimum over its own surroundings) and the minimum of another
hash over its shingles. Equal paragraphs always collide, similar ones with about their similarity, and a repeated
passage once for each paragraph whose surroundings are unchanged, so recall is set by how many paragraphs cover a
passage (:func:`recall`); the parameters are tuned for passages of over 50 words. Paragraphs with a key in common are
joined if they are equal, or if their shingles' exact Jaccard similarity is at least the threshold: each is tried against
the key's leading paragraphs first; where that leaves a key in several components, all pairs across them that share one
of their rarest shingles are tried, which no similar pair escapes. Components of joined paragraphs that reach two
documents are repeats: the first document keeps its text, the others lose theirs.

Near passages: a changed word leaves no similar paragraph around it, so longer passages meet by seeds, short runs of words
cut like anchors, and are compared by the words around these (:func:`_near`): leaders of a key with all others, then
what that leaves in several components by rare shingles. Passages of ``LEAST`` words or more that are similar as a
whole always have a seed in common, in an equal run of 24 words. Of words said on and on, where equal seeds overlap, the
first and the last of them are seeds: texts are laid side by side by where such a run begins and where it ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from breakwater.llm import graph
from breakwater.llm.bitmap import mark
from breakwater.llm.common import steady_scans, stored
from breakwater.llm.words import WordNumbers, mixed, shingles, word_bytes

# Parameters: words of a shingle and of a paragraph, shingles around an anchor, similarity in percent, leading
# paragraphs of a key that the others are compared with, rows of a key that one task takes before it is split.
SHINGLE, PARAGRAPH, REACH, PERCENT, LEADERS, SPLIT = 5, 30, 22, 80, 2, 4000
_SPAN = PARAGRAPH - SHINGLE + 1
_SECOND = np.uint64(0xA24BAED4963EE407)
# Near passages: words of a seed, runs around the least one, least words of a passage, words by which the sides of a
# passage may be out of step, pairs compared at a time; characters of the texts cut at a time.
SEED, SEED_REACH, LEAST, SLIP, PAIRS, CHARACTERS = 9, 16, 51, 12, 1000, 1 << 18
_MARGIN = LEAST - SEED
_AROUND = 2 * _MARGIN + SEED - SHINGLE + 1  # shingles around a seed, which begins at place ``_MARGIN``
_SIZE = LEAST - SHINGLE + 1
_RUN = SEED + SEED_REACH - SHINGLE
_SHARED = -(-2 * PERCENT * _SIZE // (100 + PERCENT))  # shingles that two near passages share at least
_BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def recall(words: int, kept: float) -> float:
    """Chance that two copies of a passage meet, if each paragraph's surroundings are unchanged with chance ``kept``.

    An anchor stands on average every ``(REACH + 1) / 2`` words; a passage of so many words has that many chances.
    """
    chances = max(1.0, 2 * (words - PARAGRAPH - REACH + 2) / (REACH + 1)) if words >= PARAGRAPH + REACH - 1 else 0.0
    return 1 - (1 - kept) ** chances


def _word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code-point offsets at which words begin and end."""
    (begins, ends), points = word_bytes(raw), _points_before(raw)
    return points[begins], points[ends]


def _points_before(raw: bytes) -> np.ndarray:
    """Code points before each byte and the end."""
    if raw.isascii():
        return np.arange(len(raw) + 1)
    return np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))


def _least_places(hashes: np.ndarray, reach: int) -> np.ndarray:
    """The last least place of every window, from windows of half the length, which overlap where lengths do not double."""
    at, least, length = np.arange(len(hashes)), hashes, 1
    while length < reach:
        step = min(length, reach - length)
        left, right = least[:-step], least[step:]
        at, least, length = np.where(right <= left, at[step:], at[:-step]), np.minimum(left, right), length + step
    return at


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Places of the shingles that are least among ``REACH`` neighbours, the last of equal ones, if a paragraph fits."""
    if len(hashes) < max(_SPAN, 1):
        return np.zeros(0, np.int64)
    at = _least_places(hashes, min(REACH, len(hashes)))
    found = at[np.diff(at, prepend=-1) != 0]
    return found[found <= len(hashes) - _SPAN]


class Words:
    """Words of texts laid side by side, and the runs of them that are asked for by the place of their first word."""

    def __init__(self, texts: str | list[str], numbers: WordNumbers):
        raws = [text.encode() for text in ([texts] if isinstance(texts, str) else texts)]
        self.raw, ends = b"\n".join(raws), np.cumsum([len(raw) + 1 for raw in raws])
        self.bytes = word_bytes(self.raw)
        self.words = numbers.of_places(self.raw, *self.bytes)
        self.starts, last = np.append(0, ends[:-1]), np.searchsorted(self.bytes[0], ends)
        counts = np.diff(last, prepend=0)
        self.text, self.first, self.last = (np.repeat(x, counts) for x in (np.arange(len(counts)), last - counts, last))
        self.firsts = last - counts

    @cached_property
    def hashes(self) -> np.ndarray:
        return shingles(self.words, SHINGLE) if len(self.words) >= PARAGRAPH else np.zeros(0, np.uint64)

    @cached_property
    def _short(self) -> np.ndarray:
        return (mixed(self.words) >> np.uint64(32)).astype(np.uint32)

    @cached_property
    def points(self) -> np.ndarray:
        """Code points before each byte and the end."""
        return _points_before(self.raw)

    def places_of(self, texts: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Places of words that begin at code points of texts."""
        return np.searchsorted(self.points[self.bytes[0]], self.points[self.starts[texts]] + points)

    def around(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words within which every passage of ``LEAST`` words lies that holds a seed."""
        return np.maximum(self.first[at], at - _MARGIN), np.minimum(self.last[at], at + LEAST)

    def sets_at(self, at: np.ndarray) -> list[bytes]:
        """Shingles of paragraphs, rising, each once."""
        if not len(at):
            return []
        held = np.sort(np.lib.stride_tricks.sliding_window_view(self.hashes, _SPAN)[at], axis=1)
        again = (held[:, 1:] == held[:, :-1]).any(axis=1)
        raw, size = held.tobytes(), 8 * _SPAN
        return [np.unique(held[i]).tobytes() if more else raw[i * size : i * size + size] for i, more in enumerate(again.tolist())]

    def words_at(self, at: np.ndarray) -> list[bytes]:
        """Words around seeds as 32-bit numbers, after their number before the seed."""
        begins, ends = self.around(at)
        raw, before = self._short.tobytes(), (at - begins).astype("<u4").tobytes()
        places = zip(range(0, 4 * len(at), 4), (4 * begins).tolist(), (4 * ends).tolist())
        return [before[k : k + 4] + raw[begin:end] for k, begin, end in places]


class Paragraphs(Words):
    """Paragraphs and seeds of texts cut side by side; what else they have is worked out where it is asked for.

    Keys of paragraphs are even, those of seeds odd, so that the two never meet.
    """

    def __init__(self, texts: str | list[str], numbers: WordNumbers):
        super().__init__(texts, numbers)
        self.left = self.last - np.arange(len(self.words))
        self.at = self._leasts(self.hashes, REACH, SHINGLE, PARAGRAPH)
        self.at = self.at[self.left[self.at] >= PARAGRAPH]
        second = mixed(self.hashes ^ _SECOND)
        least = np.lib.stride_tricks.sliding_window_view(second, _SPAN)[self.at].min(axis=1) if len(self.at) else second[:0]
        self.keys = (mixed(self.hashes[self.at] * np.uint64(3) + least) & ~np.uint64(1)).view(np.int64)

    def _leasts(self, hashes: np.ndarray, reach: int, size: int, words: int) -> np.ndarray:
        """Places of runs of ``size`` words that are least among ``reach`` in a text of so many words."""
        if len(hashes) < reach:
            return np.zeros(0, np.int64)
        at, here = _least_places(hashes, reach), slice(0, len(hashes) - reach + 1)
        at = at[(self.left[here] >= reach + size - 1) & (self.last[here] - self.first[here] >= words)]
        return at[np.diff(at, prepend=-1) != 0]

    @cached_property
    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        before = self.points[self.starts[self.text[self.at]]]
        return self.points[self.bytes[0][self.at]] - before, self.points[self.bytes[1][self.at + PARAGRAPH - 1]] - before

    @property
    def begins(self) -> np.ndarray:
        return self._places[0]

    @property
    def ends(self) -> np.ndarray:
        return self._places[1]

    @cached_property
    def digests(self) -> np.ndarray:
        return self.digests_of(np.arange(len(self.at)))

    def digests_of(self, some: np.ndarray) -> np.ndarray:
        at, digests = self.at[some], np.zeros(len(some), np.uint64)
        for k in range(0, _SPAN, SHINGLE):  # every SHINGLE-th shingle and the last one have all words between them
            digests = mixed(digests * np.uint64(3) + self.hashes[at + k])
        return mixed(digests * np.uint64(3) + self.hashes[at + _SPAN - 1]).view(np.int64)

    def set_of(self, i: int) -> bytes:
        return self.sets_at(self.at[[i]])[0]

    @cached_property
    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of seeds, in texts that are long enough for a near passage."""
        hashes = shingles(self.words, SEED) if len(self.words) >= LEAST else np.zeros(0, np.uint64)
        at = self._ends(hashes, self._leasts(hashes, SEED_REACH, SEED, LEAST))
        return at, (mixed(hashes[at]) | np.uint64(1)).view(np.int64)

    def _ends(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``at``, with the first and the last place in place of all those whose equal runs of words overlap on and on."""
        found, apart, place = [], np.ones(len(at), bool), np.arange(len(hashes))
        for period in range(1, SEED):
            if not ((hashes[at] == hashes[at - period]) | (hashes[at] == np.roll(hashes, -period)[at]))[apart].any():
                continue
            as_before = (place - self.first[place] >= period) & (self.left[place] >= SEED)
            as_before[period:] &= hashes[period:] == hashes[:-period]
            as_before = np.append(as_before, np.zeros(-len(hashes) % period + period, bool))
            said = apart & (as_before[at] | as_before[at + period])
            if not said.any():
                continue
            apart &= ~said
            first, last = (np.where(x, y, np.arange(len(x))).reshape(-1, period) for x, y in ((as_before[:-period], -1), (as_before[period:], len(as_before))))
            found.append(np.maximum.accumulate(first, axis=0).ravel()[at[said]])
            found.append(np.minimum.accumulate(last[::-1], axis=0)[::-1].ravel()[at[said]])
        return np.unique(np.concatenate((at[apart], *found)))

    @cached_property
    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        powers, back = (np.cumprod(np.full(len(self.words), base)) for base in _BASES)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(self.words) * powers, dtype=np.uint64))), back

    def surroundings_of(self, some: np.ndarray) -> np.ndarray:
        """Digests of seeds with the words around them."""
        at = self.seeds[0][some]
        (begin, end), (sums, back) = self.around(at), self._sums
        run = (sums[end] - sums[begin]) * back[begin]
        return mixed(mixed(run) + ((at - begin) * 1000 + end - begin).astype(np.uint64)).view(np.int64)

    def words_of(self, i: int) -> bytes:
        return self.words_at(self.seeds[0][[i]])[0]


def _apart(texts: np.ndarray, begins: np.ndarray, ends: np.ndarray, keys: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal runs of a text that overlap are one, so that a phrase said on and on is one row; begins rise in each text."""
    order = np.argsort(mixed(mixed(digests.view(np.uint64)) + keys.view(np.uint64)) + texts.astype(np.uint64), kind="stable")
    texts, begins, ends, keys, digests = (x[order] for x in (texts, begins, ends, keys, digests))
    if not len(order):
        return begins, ends, keys, digests, texts
    apart = (keys[1:] != keys[:-1]) | (digests[1:] != digests[:-1]) | (begins[1:] > ends[:-1]) | (texts[1:] != texts[:-1])
    first = np.flatnonzero(np.concatenate(([True], apart)))
    return begins[first], np.maximum.reduceat(ends, first), keys[first], digests[first], texts[first]


def _joined(own: Paragraphs) -> tuple[np.ndarray, ...]:
    """Begins, ends, keys, digests and texts of paragraphs."""
    return _apart(own.text[own.at], own.begins, own.ends, own.keys, own.digests)


def _joined_seeds(own: Paragraphs) -> tuple[np.ndarray, ...]:
    """The same of seeds; begins and ends are numbers of words."""
    at, keys = own.seeds
    begins = at - own.first[at]
    return _apart(own.text[at], begins, begins + SEED, keys, own.surroundings_of(np.arange(len(at))))


_UNITS = "row long, span long, key long, digest long"


def _portions(batch) -> Iterator[tuple]:
    """Rows of a batch and their texts, a bounded number of characters at a time (or one text)."""
    low, texts, size = 0, [], 0
    for text in batch.column(1):
        text = text.as_py() or ""
        if texts and size + len(text) > CHARACTERS:
            yield batch.slice(low, len(texts)), texts
            low, texts, size = low + len(texts), [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield batch.slice(low, len(texts)), texts


def _cut(batches: Iterable) -> Iterator:
    """``row, text`` to paragraphs and seeds; ``span`` has begin and end in its upper and lower half, that of a seed its word."""
    import pyarrow as pa

    numbers = WordNumbers()
    for batch in batches:
        for part, texts in _portions(batch):
            rows, own = part.column(0).to_numpy(), Paragraphs(texts, numbers)
            begins, ends, keys, digests, of = _joined(own)
            words, _, seeds, around, held = _joined_seeds(own)
            parts = ((rows[of], rows[held]), (begins << 32 | ends, words), (keys, seeds), (digests, around))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p).astype(np.int64)) for p in parts], ["row", "span", "key", "digest"])


def _asked(part) -> tuple[np.ndarray, list]:
    """Of a portion whose third column lists what is asked of each text: the texts, and the columns of what is asked."""
    asked = part.column(2)
    return np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy()), asked.flatten().flatten()


_MET = "key long, node long, rank int, twice boolean, splits int, tokens binary"


def _sets(batches: Iterable) -> Iterator:
    """``row, text`` and the units asked for, with the span of each in this text, to these units and their tokens."""
    import pyarrow as pa

    numbers = WordNumbers()
    for batch in batches:
        for part, texts in _portions(batch):
            own, (of, (spans, *columns)) = Words(texts, numbers), _asked(part)
            spans, seed = spans.to_numpy(), columns[0].to_numpy() & 1 == 1
            seeds, paragraphs = np.flatnonzero(seed), np.flatnonzero(~seed)
            tokens = own.words_at(own.firsts[of[seeds]] + spans[seeds])
            tokens += own.sets_at(own.places_of(of[paragraphs], spans[paragraphs] >> 32))
            order = pa.array(np.concatenate((seeds, paragraphs)))
            arrays = [column.take(order) for column in columns] + [pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "node", "rank", "twice", "splits", "tokens"])


def _aligned(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles around seeds, a row for each, seeds one below the other; and which of the places have one."""
    words, sizes = np.zeros((len(tokens), _AROUND + SHINGLE - 1), np.uint64), np.zeros((len(tokens), 2), np.int64)
    for i, own in enumerate(tokens):
        own = np.frombuffer(own, np.uint32)
        begin = _MARGIN - int(own[0])
        words[i, begin : begin + len(own) - 1] = own[1:]
        sizes[i] = begin, begin + len(own) - SHINGLE
    found = np.zeros((len(tokens), _AROUND), np.uint64)
    for k in range(SHINGLE):
        found = mixed(found * _SECOND + words[:, k : k + _AROUND] + np.uint64(1))
    places = np.arange(_AROUND)
    return found, (places >= sizes[:, :1]) & (places < sizes[:, 1:])


def _listed(there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that each row has, rising, in as many columns as the fullest row asks for; and which of these are places."""
    sizes = there.sum(axis=1)
    places = np.argsort(~there, axis=1, kind="stable")[:, : sizes.max(initial=0)]
    return places, np.arange(places.shape[1]) < sizes[:, None]


def _near(around: tuple[np.ndarray, np.ndarray], one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs hold near passages around their seed, and the passages: begin and end in words from the seed, of both.

    Near are passages of ``LEAST`` words or more whose shingles, in order and as often as they stand, have a Jaccard
    similarity of ``PERCENT``. Passages end where they begin and end to be alike: the one that shares most begins and ends
    with a run that both sides have, as more of a run is only more alike. Such passages have an equal run of
    ``SEED + SEED_REACH - 1`` words: a gap costs four shingles of either, so there are too few gaps for shorter runs. It
    holds a seed, so pairs whose run around this seed is shorter are left to another one.
    """
    shingled, there = around
    kept, spans = [], []
    for low in range(0, len(one), PAIRS):
        x, y = one[low : low + PAIRS], other[low : low + PAIRS]
        apart, place = (shingled[x] != shingled[y]) | ~there[x] | ~there[y], np.arange(_AROUND)
        back = _MARGIN - np.where(apart[:, : _MARGIN + 1], place[: _MARGIN + 1], -1).max(axis=1)
        on = np.where(apart[:, _MARGIN:], place[_MARGIN:], _AROUND).min(axis=1) - _MARGIN
        long = np.flatnonzero((back > 0) & (back + on - 1 >= _RUN))
        if not len(long):
            continue
        x, y = x[long], y[long]
        own = np.where(there[x], shingled[x], np.uint64(0))
        theirs = np.pad(np.where(there[y], shingled[y], np.uint64(1)), ((0, 0), (SLIP, SLIP)), constant_values=1)
        place, where, free = place.astype(np.int16), np.full(own.shape, -1, np.int16), np.ones(own.shape, bool)
        for step in sorted(range(-SLIP, SLIP + 1), key=abs):
            same = own == theirs[:, SLIP + step : SLIP + step + _AROUND]
            same &= free
            np.copyto(where, place + np.int16(step), where=same)
            free ^= same
        before = np.maximum.accumulate(where, axis=1)[:, :-1]
        where[:, 1:][where[:, 1:] <= before] = -1
        some = np.flatnonzero((where >= 0).sum(axis=1) >= _SHARED)
        where = where[some]
        hit, seed = where >= 0, slice(_MARGIN, _MARGIN + SEED - SHINGLE + 1)
        some, where, hit = (v[hit[:, seed].all(axis=1)] for v in (some, where, hit))
        count, row = np.cumsum(hit, axis=1), np.arange(len(some))[:, None]
        goes_on = hit[:, 1:] & (where[:, 1:] == where[:, :-1] + 1) & hit[:, :-1]
        begins, ends = hit[:, : _MARGIN + 1].copy(), hit[:, _MARGIN + SEED - SHINGLE :].copy()
        begins[:, 1:] &= ~goes_on[:, :_MARGIN]
        ends[:, :-1] &= ~goes_on[:, _MARGIN + SEED - SHINGLE :]
        (begins, begun), (ends, ended) = _listed(begins), _listed(ends)
        ends += _MARGIN + SEED - SHINGLE
        shared = count[row, ends][:, None, :] - count[row, begins][:, :, None] + 1
        width = np.maximum(ends[:, None, :] - begins[:, :, None] + 1, _SIZE)
        other_width = np.maximum(where[row, ends].astype(np.int64)[:, None, :] - where[row, begins][:, :, None] + 1, _SIZE)
        alike = ((100 + PERCENT) * shared >= PERCENT * (width + other_width)) & begun[:, :, None] & ended[:, None, :]
        best = np.where(alike, shared, 0).reshape(len(some), alike.shape[1] * alike.shape[2])
        if not best.size:
            continue
        top = best.argmax(axis=1)
        good = np.flatnonzero(best[row[:, 0], top] > 0)
        begins, ends = begins[good, top[good] // alike.shape[2]], ends[good, top[good] % alike.shape[2]]
        kept.append(low + long[some[good]])
        columns = (begins, ends + SHINGLE, where[good, begins], where[good, ends] + SHINGLE)
        spans.append(np.stack(columns, axis=1) - _MARGIN)
    if not kept:
        return np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
    return np.concatenate(kept), np.concatenate(spans)


# Links: what is joined, the nodes that were compared, and their near passages (nothing for paragraphs).
_LINKS = "a long, b long, one long, other long, one_begin long, one_end long, other_begin long, other_end long"
_LINK_NAMES = [part.split()[0] for part in _LINKS.split(", ")]


def _link_batch(rows: list):
    import pyarrow as pa

    columns = np.array(rows, np.int64).reshape(len(rows), len(_LINK_NAMES))
    return pa.RecordBatch.from_arrays([pa.array(columns[:, i]) for i in range(len(_LINK_NAMES))], _LINK_NAMES)


def _own_links(node: int, tokens: bytes) -> list[list[int]]:
    """A link of a node to itself that claims all its words, which two documents have, at an end of words said on and on."""
    before, size = int.from_bytes(tokens[:4], "little"), len(tokens) // 4 - 1
    at, long = 4 + 4 * before, 4 * SEED
    places = (at + 4 * step for step in range(1 - SEED, SEED) if step and before + step >= 0)
    said = any(tokens[place : place + long] == tokens[at : at + long] for place in places)
    return [[node, node, node, node, -before, size - before, -before, size - before]] if said else []


def _compare(batches: Iterable) -> Iterator:
    """Rows by ``key, salt, rank``, leaders first, to the pairs of a leader and a similar paragraph."""
    at, leaders = None, []
    for batch in batches:
        links = []
        for (key, salt), group in groupby(batch.to_pylist(), lambda row: (row["key"], row["salt"])):
            if at != (key, salt):
                at, leaders = (key, salt), []
            rows = list(group)
            if key & 1:
                leaders += [row for row in rows if row["rank"] <= LEADERS]
                rows = leaders + [row for row in rows if row["rank"] > LEADERS]
                one, other = np.divmod(np.arange(len(leaders) * len(rows)), len(rows))
                one, other = one[one < other], other[one < other]
                good, spans = _near(_aligned([row["tokens"] for row in rows]), one, other)
                for i, j, span in zip(one[good].tolist(), other[good].tolist(), spans.tolist()):
                    pair = [rows[i]["node"], rows[j]["node"]]
                    links.append([*pair, *pair, *span])
                links += [link for row in rows if row["twice"] for link in _own_links(row["node"], row["tokens"])]
                continue
            for row in rows:
                own = np.frombuffer(row["tokens"], np.uint64)
                for node, other in leaders:
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * shared >= PERCENT * (len(own) + len(other) - shared):
                        links.append([node, row["node"], node, row["node"], 0, 0, 0, 0])
                if row["rank"] <= LEADERS:
                    leaders.append((row["node"], own))
        yield _link_batch(links)


def _counted(around: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Shingles of each row, each with how often it stood there before: as many numbers as shingles.

    Near rows have ``_SHARED`` of these in common, as they share shingles as often as they stand. Were words that are
    said on and on one number, two rows with little else in common would share the rarest ones of the few they have.
    """
    shingled, there = around
    order = np.argsort(shingled, axis=1)
    ordered, place = np.take_along_axis(shingled, order, axis=1), np.arange(shingled.shape[1])
    new = np.ones(shingled.shape, bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    times = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
    counted, there = ordered + times.astype(np.uint64) * _SECOND, np.take_along_axis(there, order, axis=1)
    return np.split(counted[there], np.cumsum(there.sum(axis=1))[:-1])


def _rare(around: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and numbers of the rare shingles one of which any two near rows share."""
    counted = _counted(around)
    sizes = np.array([len(own) for own in counted])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, number, times = np.unique(np.concatenate(counted), return_inverse=True, return_counts=True)
    order = np.lexsort((number, times[number], rows))
    number = number[order]
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = (nth <= (sizes - _SHARED)[rows]) & (times[number] > 1)
    rows, number = rows[first], number[first]
    order = np.lexsort((rows, number))
    return rows[order], number[order]


def _bands(around: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Two numbers of each row, one of which is equal in rows whose equal run is long enough for near passages.

    Half of what such a run exceeds the seed by lies on one side of it.
    """
    side, bands = (_RUN - (SEED - SHINGLE) - 1) // 2 + 1, []
    for begin in (_MARGIN - side, _MARGIN):
        band = np.zeros(len(around[0]), np.uint64)
        for column in around[0][:, begin : begin + side + SEED - SHINGLE + 1].T:
            band = mixed(band * _SECOND + column)
        bands.append(band)
    return bands


def _group_links(
    nodes: np.ndarray, around: tuple[np.ndarray, np.ndarray], bands: list[np.ndarray], held: np.ndarray, leaders: int = LEADERS, blocks: np.ndarray | None = None
) -> Iterator[list]:
    """Links between components ``held`` of one key's rows, by rare shingles that they share; leaders have met all others.

    Of rows of two ``blocks``, those of one meet those of the other.
    """
    met = (bands[0][:, None] == bands[0]) | (bands[1][:, None] == bands[1])
    met &= held[:, None] != held
    met[:leaders], met[:, :leaders] = False, False
    if blocks is not None:
        met &= blocks[:, None] != blocks
    some = np.flatnonzero(met.any(axis=1))
    if not len(some):
        return
    rows, number = _rare((around[0][some], around[1][some]))
    if not len(rows):
        return
    rows = some[rows]
    sets = {members.tobytes(): members for members in np.split(rows, np.flatnonzero(np.diff(number)) + 1)}
    tried = np.zeros((len(held), len(held)), bool)
    for members in sets.values():
        if (held[members] != held[members[0]]).any():
            tried[members[:, None], members] = True
    tried = np.flatnonzero(np.triu(tried & met))
    for low in range(0, len(tried), PAIRS):
        one, other = np.divmod(tried[low : low + PAIRS], len(held))
        open_ = held[one] != held[other]
        one, other = one[open_], other[open_]
        good, spans = _near(around, one, other)
        for i, j, span in zip(one[good].tolist(), other[good].tolist(), spans.tolist()):
            if held[i] != held[j]:
                yield [nodes[i], nodes[j], nodes[i], nodes[j], *span]
                held[held == held[j]] = held[i]


def _groups_links(sizes: np.ndarray, nodes: np.ndarray, tokens: list[bytes]) -> list[list]:
    """Links of whole keys of so many rows, which rise by rank: the leaders with all others, then what that leaves apart."""
    starts, around = np.cumsum(sizes) - sizes, _aligned(tokens)
    begins = np.repeat(starts, sizes)
    nth = np.arange(len(nodes)) - begins
    other = [np.flatnonzero(nth > leader) for leader in range(LEADERS)]
    one, other = np.concatenate([begins[rows] + leader for leader, rows in enumerate(other)]), np.concatenate(other)
    good, spans = _near(around, one, other)
    one, other = one[good], other[good]
    links = np.concatenate((np.stack((nodes[one], nodes[other], nodes[one], nodes[other]), axis=1), spans), axis=1).tolist()
    held, bands = np.arange(len(nodes)), _bands(around)
    by_group = np.searchsorted(starts, one, side="right") - 1
    order = np.argsort(by_group, kind="stable")
    bounds = np.searchsorted(by_group[order], np.arange(len(sizes) + 1))
    for g in np.flatnonzero(sizes > LEADERS + 1).tolist():
        own, of = slice(starts[g], starts[g] + sizes[g]), order[bounds[g] : bounds[g + 1]]
        part = held[own]
        for i, j in zip((one[of] - starts[g]).tolist(), (other[of] - starts[g]).tolist()):
            if part[i] != part[j]:
                part[part == part[j]] = part[i]
        if (part != part[0]).any():
            links += _group_links(nodes[own], (around[0][own], around[1][own]), [band[own] for band in bands], part)
    return links


def _near_links(batches: Iterable) -> Iterator:
    """Rows by ``key, rank`` to links, whole keys at a time."""
    import pyarrow as pa

    waiting, rows = [], 0

    def links(table) -> pa.RecordBatch:
        keys, nodes = table.column("key").to_numpy(), table.column("node").to_numpy()
        starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        tokens = table.column("tokens").to_pylist()
        own = [link for i in np.flatnonzero(table.column("twice").to_numpy()).tolist() for link in _own_links(int(nodes[i]), tokens[i])]
        return _link_batch(_groups_links(np.diff(starts, append=len(keys)), nodes, tokens) + own)

    for batch in batches:
        waiting.append(batch)
        rows += len(batch)
        if rows < PAIRS:
            continue
        table = pa.Table.from_batches(waiting)
        keys = table.column("key").to_numpy()
        whole = int(np.flatnonzero(np.diff(keys, prepend=~keys[:1]))[-1])
        if whole:
            yield links(table.slice(0, whole))
        waiting, rows = table.slice(whole).to_batches(), len(keys) - whole
    if rows:
        yield links(pa.Table.from_batches(waiting))


def _salted(frame: DataFrame) -> DataFrame:
    """A row for each split of a key."""
    return frame.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))


def _salt(of: str) -> Column:
    return F.pmod(F.xxhash64(of), F.col("splits")).cast("int").alias("salt")


def _is_seed() -> Column:
    return F.col("key").bitwiseAND(F.lit(1)) == 1


def _asking(texts: DataFrame, units: DataFrame, *columns: str | Column) -> DataFrame:
    """``row, text`` of the texts that ``units`` ask, and a list of the columns of those: as many rows as there are texts."""
    return texts.join(units.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("asked")), "row").select("row", "text", "asked")


def _met(texts: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, node, rank, twice, splits, tokens`` of the nodes that share their key; sets are cut from their texts again.

    Each text meets the list of what is asked of it, so that nothing else is cut, however many nodes there are.
    Seeds of keys that one task takes whole are linked there at once; of all others, the nodes.
    """
    held = Window.partitionBy("key")
    several = nodes.withColumn("n", F.count("*").over(held)).where("n > 1")
    ranked = several.withColumn("rank", F.row_number().over(held.orderBy(F.desc("rows"), "digest")))
    twice, splits = (F.col("row") != F.col("last")).alias("twice"), F.ceil(F.col("n") / SPLIT).cast("int").alias("splits")
    sets = stored(_asking(texts, ranked, "span", "key", "node", "rank", twice, splits).mapInArrow(_sets, _MET))
    whole = _is_seed() & (F.col("splits") == 1)
    links = sets.where(whole).select("key", "node", "rank", "twice", "tokens").repartition("key")
    return stored(sets.where(~whole)), stored(links.sortWithinPartitions("key", "rank").mapInArrow(_near_links, _LINKS))


def _links(met: DataFrame) -> DataFrame:
    """Nodes of one key that are similar, each tried against the key's leaders."""
    leaders = F.when(F.col("rank") <= LEADERS, F.sequence(F.lit(0), F.col("splits") - 1)).otherwise(F.array(_salt("node")))
    dealt = met.select("key", "node", "rank", "twice", "tokens", F.explode(leaders).alias("salt"))
    ordered = dealt.repartition("key", "salt").sortWithinPartitions("key", "salt", "rank")
    return ordered.mapInArrow(_compare, _LINKS).distinct()


def _words(batches: Iterable) -> Iterator:
    """``key, node, component, tokens`` to a row for each token; of two similar sets one shares a token with the other
    among the first ``places`` of each, in any order that both keep."""
    import pyarrow as pa

    for batch in batches:
        sets = [np.frombuffer(tokens, np.int64) for tokens in batch.column(3).to_pylist()]
        places = [len(own) + PERCENT * len(own) // -100 + 1 for own in sets]
        sizes = np.array([len(own) for own in sets], np.int64)
        places = np.array(places, np.int64)
        columns = [np.repeat(x, sizes) for x in (*(batch.column(i).to_numpy() for i in range(3)), places)]
        columns.append(np.concatenate([np.zeros(0, np.int64), *sets]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "node", "component", "places", "token"])


def _try_across(batches: Iterable) -> Iterator:
    """Rows by ``key, token, one, other`` to pairs of components that hold a similar pair."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, group in groupby(rows, lambda row: (row["key"], row["token"], row["one"], row["other"])):
        group, links = list(group), []
        held, nodes = (np.array([row[name] for row in group]) for name in ("component", "node"))
        sets = [np.frombuffer(row["tokens"], np.uint64) for row in group]
        sizes = np.array([len(own) for own in sets])
        flat, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
        names, counts = np.unique(held, return_counts=True)
        for i in np.flatnonzero(held != names[counts.argmax()]):
            own = sets[i]
            found = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            shared = np.add.reduceat(found.astype(np.int64), starts)
            for j in np.flatnonzero((held != held[i]) & (100 * shared >= PERCENT * (sizes + sizes[i] - shared))):
                if held[j] != held[i]:
                    links.append([held[i], held[j], nodes[i], nodes[j], 0, 0, 0, 0])
                    held[held == held[j]] = held[i]
        if links:
            yield _link_batch(links)


def _try_blocks(batches: Iterable) -> Iterator:
    """Rows by ``key, one, other, rank`` to pairs of components that hold a near pair."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for (_, one, other), group in groupby(rows, lambda row: (row["key"], row["one"], row["other"])):
        group = list(group)
        held, nodes, blocks = (np.array([row[name] for row in group], np.int64) for name in ("component", "node", "block"))
        around, leaders = _aligned([row["tokens"] for row in group]), sum(row["rank"] <= LEADERS for row in group)
        named = dict(zip(nodes.tolist(), held.tolist()))
        found = _group_links(nodes, around, _bands(around), held, leaders, None if one == other else blocks)
        links = [[named[int(a)], named[int(b)], a, b, *span] for _, _, a, b, *span in found]
        if links:
            yield _link_batch(links)


def _blocks(named: DataFrame) -> DataFrame:
    """``named`` once for each block of its key: every two blocks, ``one`` and ``other``, meet in a task."""
    blocks = named.withColumn("block", _salt("node")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    return blocks.withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with")).drop("with", "splits")


def _across_seeds(left: DataFrame) -> DataFrame:
    """The same of seeds: each two rows of a key meet in one task alone, however many shingles they share."""
    ordered = _blocks(left).repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "rank")
    return ordered.mapInArrow(_try_blocks, _LINKS)


def _across_sets(left: DataFrame) -> DataFrame:
    """Components of paragraphs in one key that hold a similar pair.

    Sets of similarity ``PERCENT`` share one of their rarest tokens of the key, so only those that do meet. Many rows of
    one token are dealt into blocks, and each two blocks meet in a task.
    """
    left = left.select("key", "node", "component", "tokens")
    words = left.mapInArrow(_words, "key long, node long, component long, places long, token long")
    times = words.groupBy("key", "token").agg(F.count("*").alias("times"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    nth = F.row_number().over(Window.partitionBy("node").orderBy("times", "token"))
    rare = words.join(times, ["key", "token"]).withColumn("nth", nth).where("nth <= places and lo <> hi")
    placed = _blocks(rare.select("key", "token", "node", "component", F.ceil(F.col("times") / SPLIT).cast("int").alias("splits"))).drop("block")
    asked = placed.join(left.select("node", "tokens"), "node")
    ordered = asked.repartition("key", "token", "one", "other").sortWithinPartitions("key", "token", "one", "other")
    return ordered.mapInArrow(_try_across, _LINKS).distinct()


def _across(met: DataFrame, found: DataFrame) -> DataFrame:
    """Components of ``found`` in one key that hold a similar pair; a node in none is its own component.

    Keys with one node beside their leaders are left out, as all their pairs are tried by then.
    """
    named = met.select("key", "node", "rank", "tokens").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("rank").alias("n"))
    splits = F.ceil(F.col("n") / max(SPLIT // 2, 1)).cast("int").alias("splits")
    split = held.where((F.col("lo") != F.col("hi")) & (F.col("n") > LEADERS + 1)).select("key", splits)
    left = stored(named.join(split, "key").select("key", "node", "rank", "component", "splits", "tokens"))
    return _across_sets(left.where(~_is_seed())).unionByName(_across_seeds(left.where(_is_seed())))


def _spans(links: DataFrame) -> DataFrame:
    """``node, left, right``: the words around each seed that are in a near passage."""
    found = [links.select(F.col(side).alias("node"), F.col(f"{side}_begin").alias("left"), F.col(f"{side}_end").alias("right")) for side in ("one", "other")]
    return found[0].unionByName(found[1]).where("right > 0").groupBy("node").agg(F.min("left").alias("left"), F.max("right").alias("right"))


def _components(met: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``node, component`` of the stars, ``component, whole`` of components joined across, near passages of nodes."""
    stars = stored(_links(met).unionByName(near))
    found = graph.components(stars)
    across = stored(_across(met, found))
    whole = graph.components(across)
    return found, whole.select(F.col("node").alias("component"), F.col("component").alias("whole")), _spans(stars.unionByName(across))


# One number for a word in a row, which only a test asks for since texts meet what is asked of them by their row. Rows are
# numbered by partition, from this bit on, and place in it; the factors spread both and the words over 64 bits.
_ROW_BITS, _PARTITION, _FACTORS = 38, 33, (1000003, 15485863, 7919)


def _word_mark() -> Column:
    """One number for a word in a row; the same as ``_word_marks``."""
    parts = F.col("row").bitwiseAND(F.lit((1 << _PARTITION) - 1)), F.shiftright("row", _PARTITION), F.col("word")
    return mark(F.shiftleft(sum(part * factor for part, factor in zip(parts, _FACTORS)), _ROW_BITS)).alias("mark")


def _word_marks(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    parts = rows & ((1 << _PARTITION) - 1), rows >> _PARTITION, words
    return sum(part * factor for part, factor in zip(parts, _FACTORS)) << _ROW_BITS


def _points(batches: Iterable) -> Iterator:
    """``row, text`` and the words asked for, begin and end first, to these with begin and end in code points."""
    import pyarrow as pa

    for batch in batches:
        for part, texts in _portions(batch):
            raws = [text.encode() for text in texts]
            raw, ends = b"\n".join(raws), np.cumsum([len(own) + 1 for own in raws])
            (begin, end), points = word_bytes(raw), _points_before(raw)
            starts = np.append(0, ends[:-1])
            of, (first, last, *columns) = _asked(part)
            firsts, before = np.searchsorted(begin, starts)[of], points[starts[of]]
            arrays = [part.column(0).take(pa.array(of)), pa.array(points[begin[firsts + first.to_numpy()]] - before)]
            arrays += [pa.array(points[end[firsts + last.to_numpy() - 1]] - before), *columns]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "begin", "end", "keeper_row", "class_id", "n_paragraphs"])


def _in_points(texts: DataFrame, near: DataFrame) -> DataFrame:
    """``near`` with begin and end in code points in place of words; the texts it is about are read once more."""
    near = near.select("row", "begin", "end", "keeper_row", "class_id", "n_paragraphs")
    return _asking(texts, near, *near.columns[1:]).mapInArrow(_points, near.schema)


def _repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``row, begin, end, keeper_row, class_id`` of paragraphs that another document has too, and of near passages.

    Those of near passages count words, the others code points.
    """
    steady_scans(docs)
    own = docs.select(F.monotonically_increasing_id().alias("row"), "text")
    held = Window.partitionBy("key")
    met = own.mapInArrow(_cut, _UNITS).select(
        "*",
        F.min("row").over(held).alias("lo"),
        F.max("row").over(held).alias("hi"),
        F.count("*").over(held).alias("n"),
        F.min("digest").over(held).alias("least"),
        F.max("digest").over(held).alias("most"),
    )
    # Seeds whose surroundings are all equal are left out: those texts share whole paragraphs.
    met = met.where((F.col("lo") != F.col("hi")) & (~_is_seed() | (F.col("least") != F.col("most"))))
    shared = stored(met.select("row", "span", "key", "digest", F.ceil(F.col("n") / SPLIT).cast("int").alias("splits")))
    counted = shared.groupBy("key", "digest").agg(
        F.count("*").alias("rows"),
        F.min("row").alias("row"),
        F.max("row").alias("last"),
        F.max("splits").alias("splits"),
        F.min_by("span", "row").alias("span"),
    )
    nodes = stored(counted.withColumn("node", F.monotonically_increasing_id()))
    found, wholes, spans = _components(*_met(own, nodes.select("key", "digest", "node", "row", "last", "rows", "span")))
    starred = nodes.drop("span").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = starred.join(wholes, "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole")
    # Components and what they reach are worked out on distinct paragraphs, before their copies come in.
    reach = classes.groupBy("component").agg(F.min("row").alias("keeper_row"), F.max("last").alias("last")).where("keeper_row <> last")
    ids = docs.select(F.monotonically_increasing_id().alias("keeper_row"), F.col("doc_id").alias("class_id"))
    named = classes.join(reach.drop("last").join(ids, "keeper_row"), "component").join(spans, "node", "left")
    named = named.where(~_is_seed() | F.col("right").isNotNull())
    kept = _salted(named.select("key", "digest", "splits", "keeper_row", "class_id", "left", "right")).drop("splits")
    held = stored(shared.withColumn("salt", _salt("row")).join(kept, ["key", "digest", "salt"]).drop("salt", "splits", "digest"))
    equal = held.where(~_is_seed()).select(
        "row", F.shiftright("span", 32).alias("begin"), F.col("span").bitwiseAND(F.lit(0xFFFFFFFF)).alias("end"), "keeper_row", "class_id"
    )
    near = held.where(_is_seed()).select(
        "row", (F.col("span") + F.col("left")).alias("begin"), (F.col("span") + F.col("right")).alias("end"), "keeper_row", "class_id"
    )
    return equal, near


def repeats(docs: DataFrame) -> DataFrame:
    """``row, begin, end, keeper_row, class_id``: paragraphs that another document has too.

    ``row`` numbers the rows of ``docs``; the keeper is the first row that has the paragraph, ``class_id`` its
    ``doc_id``.
    """
    return _repeated(docs)[0]


def _all_repeats(docs: DataFrame) -> DataFrame:
    """Passages of equal or similar paragraphs and near passages, those that overlap made one for each keeper."""
    equal, near = _repeated(docs)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "text")
    near = _in_points(texts, merged(near).drop("removed").withColumn("n_paragraphs", F.lit(0)))
    return merged(equal.withColumn("n_paragraphs", F.lit(1)).unionByName(near))


def merged(found: DataFrame) -> DataFrame:
    """Paragraphs that overlap made one passage for each keeper, so that no link to a keeper is lost."""
    counted = (F.sum("n_paragraphs") if "n_paragraphs" in found.columns else F.count("*")).alias("n_paragraphs")
    before = Window.partitionBy("row", "keeper_row").orderBy("begin", "end")
    opened = found.withColumn("opens", F.coalesce((F.col("begin") > F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1)))
    numbered = opened.withColumn("passage", F.sum("opens").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("row", "keeper_row", "class_id", "passage").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), counted
    )
    return spans.withColumn("removed", F.col("row") != F.col("keeper_row")).drop("passage")


def passages(docs: DataFrame) -> DataFrame:
    """Every passage that two documents share: ``doc_id, class_id, start, end, removed, n_paragraphs``.

    ``class_id`` is the ``doc_id`` of the document that keeps the passage, so each row is a pair of a member
    and its representative; positions are code points, the end exclusive. Passages of one document that different
    documents keep are rows of their own and may overlap. Documents without repeats have no row.
    Null and empty texts and those shorter than a paragraph have none; a passage that only one document repeats
    stays; repeated rows are documents of their own, and the first of them keeps its text. ``n_paragraphs`` counts
    repeated paragraphs; it is 0 for a passage that is only near, as a whole, to one elsewhere.
    """
    spans = _all_repeats(docs)
    ids = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id")
    return spans.join(ids, "row").select("doc_id", "class_id", F.col("begin").alias("start"), "end", "removed", "n_paragraphs")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with removed passages, of whichever keeper, cut out of their texts; all rows and columns stay, ``n_chars`` follows."""
    spans = _all_repeats(docs if "doc_id" in docs.columns else docs.withColumn("doc_id", F.lit(None))).where("removed")
    cuts = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("cuts"))
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    met = docs.select(doc, F.monotonically_increasing_id().alias("row")).join(cuts, "row", "left")
    text, start = F.col("doc.text"), F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("upto"))

    def keep(acc, cut):
        between = F.substr(text, (acc["upto"] + 1).cast("int"), F.greatest(cut["begin"] - acc["upto"], F.lit(0)).cast("int"))
        return F.struct(F.concat(acc["kept"], between).alias("kept"), F.greatest(acc["upto"], cut["end"]).alias("upto"))

    folded = F.aggregate("cuts", start, keep)
    left = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(folded["kept"], F.substr(text, (folded["upto"] + 1).cast("int"))))
    changed = {"text": left, "n_chars": F.char_length(left).cast("long")}
    return met.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
