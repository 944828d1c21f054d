"""Ranked lexical search for many queries at once, with shared sums worked out once.

The score of an item for a document is the sum of its terms' weights there. Items share terms, so their sums share
parts: pairs of terms, or of parts, that several items hold are mined and replaced by one new part, the most common
first, until no two items share a pair. What remains is a graph of additions. For a block of documents every part is
one accumulator, a vector of the documents' partial scores, filled once from two others and read by every item above.

Items are taken in blocks of bounded size. For each, one scan counts what the weights need (documents, terms, documents
of each of the block's terms) and a second one scores every document; a task keeps the best of each item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from breakwater.llm.common import lower_ascii, prepare, stored

# Parameters: terms of all items of a block (more only where one item alone has more), numbers of a block of
# accumulators, bytes of a text cut into terms at a time, candidates held before the best are taken.
BLOCK_TERMS, ACCUMULATORS, PIECE, PENDING = 20_000, 1 << 22, 1 << 20, 1 << 16

# Fixed value: what a term is made of, digits, letters and all that is not ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

_BEST = "task int, item int, doc_id long, score long"


def item_terms(text: Column) -> Column:
    """The distinct terms of a text, A-Z in lower case."""
    return F.array_distinct(F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(f"({TERM})"), F.lit(1)))


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    raw = (text or "").encode().translate(_KEPT)
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[start:end].split()
        start = end


# -- shared parts -----------------------------------------------------------------------------------------------


@dataclass
class Graph:
    """Additions, level by level: ``(parts, left, right)``. The first parts are the terms; ``tops`` has each item's."""

    terms: int
    parts: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    tops: np.ndarray


def shared_sums(items: list[set[int]], terms: int) -> Graph:
    """The graph of additions for items of terms numbered below ``terms``. An item without terms is part -1."""
    holders: dict[int, set[int]] = defaultdict(set)
    for number, own in enumerate(items):
        for part in own:
            holders[part].add(number)
    left, right, level = {}, {}, Counter()
    rest = [set(own) for own in items]

    def pair(a: int, b: int, keep: bool = True) -> int:
        made = terms + len(left)
        left[made], right[made], level[made] = a, b, max(level[a], level[b]) + 1
        return made

    # Terms that the very same items hold are one part from the start.
    alike: dict[frozenset, list[int]] = defaultdict(list)
    for part, own in sorted(holders.items()):
        alike[frozenset(own)].append(part)
    for own, parts in alike.items():
        while len(parts) > 1:
            made = pair(heapq.heappop(parts), heapq.heappop(parts))
            heapq.heappush(parts, made)
    for number, own in enumerate(items):
        rest[number] = {parts[0] for held, parts in alike.items() if number in held}
    holders = defaultdict(set)
    for number, own in enumerate(rest):
        for part in own:
            holders[part].add(number)
    # Then the pair that most items share, over and over; counts in the heap may be too high and are mended when met.
    counts: Counter = Counter()
    for own in rest:
        parts = sorted(own)
        counts.update((a, b) for i, a in enumerate(parts) for b in parts[i + 1 :] if len(holders[a]) > 1 and len(holders[b]) > 1)
    heap = [(-n, a, b) for (a, b), n in counts.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, a, b = heapq.heappop(heap)
        both = holders[a] & holders[b]
        if len(both) < 2:
            continue
        if len(both) < -n:
            heapq.heappush(heap, (-len(both), a, b))
            continue
        made, near = pair(a, b), Counter()
        holders[made] = both
        for number in both:
            rest[number] -= {a, b}
            near.update(rest[number])
            rest[number].add(made)
        holders[a] -= both
        holders[b] -= both
        for other, together in near.items():
            if together > 1:
                heapq.heappush(heap, (-together, other, made))
    # What an item has alone: the shallowest two parts first.
    tops = np.full(len(items), -1, np.int64)
    for number, own in enumerate(rest):
        queue = [(level[p], p) for p in own]
        heapq.heapify(queue)
        while len(queue) > 1:
            made = pair(heapq.heappop(queue)[1], heapq.heappop(queue)[1])
            heapq.heappush(queue, (level[made], made))
        if queue:
            tops[number] = queue[0][1]
    by_level = defaultdict(list)
    for part in left:
        by_level[level[part]].append(part)
    levels = [tuple(np.array(x, np.int64) for x in (p, [left[i] for i in p], [right[i] for i in p])) for _, p in sorted(by_level.items())]
    return Graph(terms, terms + len(left), levels, tops)


# -- scans ------------------------------------------------------------------------------------------------------


def _counted(shared):
    """For each task the documents and terms it read, under number -1, and the documents of each of the block's terms."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        numbers = shared.value
        found, docs, total = np.zeros(len(numbers) + 1, np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                n, own = 0, set()
                for words in terms_of(text.as_py()):
                    n += len(words)
                    own.update(words)
                docs, total = docs + (n > 0), total + n
                met = own & numbers.keys()
                found[np.fromiter(map(numbers.__getitem__, met), np.int64, len(met))] += 1
        terms = np.flatnonzero(found)
        columns = [pa.array([-1, *terms], pa.int32()), pa.array([docs, *found[terms]], pa.int64()), pa.array([total] + [0] * len(terms), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "docs", "terms"])

    return run


class Best:
    """The best documents of each item among those met: highest score, then least id, nulls last."""

    def __init__(self, items: int, best: int):
        self.best, self.held, self.size = best, [], 0
        self.least = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, bare: np.ndarray, ids: np.ndarray) -> None:
        self.held.append((item, score, bare, ids))
        self.size += len(item)
        if self.size > PENDING:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        item, score, bare, ids = (np.concatenate(x) for x in zip(*self.held)) if self.held else [np.zeros(0, np.int64)] * 4
        order = np.lexsort((ids, bare, -score, item))
        item = item[order]
        first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1]))) if len(item) else item
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        last = rank == self.best - 1
        self.least[item[last]] = score[order][last]
        top = rank < self.best
        kept = (item[top], *(x[order][top] for x in (score, bare, ids)))
        self.held, self.size = [kept], len(kept[0])
        return kept


def _scored(shared, best: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        numbers, graph, weights, documents, total = shared.value
        held = max(1, ACCUMULATORS // max(1, graph.parts))
        items, found = np.flatnonzero(graph.tops >= 0), Best(len(graph.tops), best)

        def score(rows: list[tuple[int | None, int, np.ndarray]]) -> None:
            """The shared parts of a few documents, each once; then the items."""
            width = len(rows)
            at = np.concatenate([own * width + i for i, (_, _, own) in enumerate(rows)])
            cells, counts = np.unique(at, return_counts=True)
            lengths = np.array([100 - 90 + (90 * n * documents) // total for _, n, _ in rows], np.int64)
            parts = np.zeros((graph.parts, width), np.int64)
            term, doc = np.divmod(cells, width)
            parts[term, doc] = weights[term] * ((1_000_000_000 * counts) // (1000 * counts + 8 * lengths[doc]))
            for made, left, right in graph.levels:
                parts[made] = parts[left] + parts[right]
            scores = parts[graph.tops[items]]
            i, doc = np.nonzero(scores >= found.least[items][:, None])
            bare = np.array([d is None for d, _, _ in rows])
            ids = np.array([d or 0 for d, _, _ in rows], np.int64)
            found.add(items[i], scores[i, doc], bare[doc], ids[doc])

        waiting = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, own = 0, []
                for words in terms_of(text.as_py()):
                    n += len(words)
                    met = [k for k in map(numbers.get, words) if k is not None]
                    own.append(np.array(met, np.int64))
                if any(map(len, own)):
                    waiting.append((doc_id, n, np.concatenate(own)))
                if len(waiting) == held:
                    score(waiting)
                    waiting = []
        if waiting:
            score(waiting)
        item, scores, bare, ids = found.settle()
        columns = [
            pa.array([TaskContext.get().partitionId()] * len(item), pa.int32()),
            pa.array(item, pa.int32()),
            pa.array(ids, pa.int64(), mask=bare.astype(bool)),
            pa.array(scores, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["task", "item", "doc_id", "score"])

    return run


# -- the operator -----------------------------------------------------------------------------------------------


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _blocks(items: DataFrame) -> Iterator[tuple[list[int | None], list[list[str]]]]:
    """Items with their terms, as many at a time as a block holds; the driver sees one block."""
    ids, terms, size = [], [], 0
    for row in items.toLocalIterator():
        if ids and size + len(row.terms) > BLOCK_TERMS:
            yield ids, terms
            ids, terms, size = [], [], 0
        ids.append(row.item_id)
        terms.append(row.terms)
        size += len(row.terms)
    if ids:
        yield ids, terms


def _block(docs: DataFrame, ids: list[int | None], terms: list[list[str]], best: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    numbers = {t.encode(): k for k, t in enumerate(sorted({t for own in terms for t in own}))}
    counted = docs.select("text").mapInArrow(_counted(context.broadcast(numbers)), "term int, docs long, terms long")
    facts = {r.term: r for r in counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect()}
    documents, total = (facts[-1].docs, facts[-1].terms) if -1 in facts else (0, 0)
    weights = np.array([weight(documents, facts[k].docs if k in facts else 0) for k in range(len(numbers))], np.int64)
    graph = shared_sums([{numbers[t.encode()] for t in own} for own in terms], len(numbers))
    shared = context.broadcast((numbers, graph, weights, documents, total))
    found = docs.select("doc_id", "text").mapInArrow(_scored(shared, best), _BEST)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", F.pmod("task", F.lit(16))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= best)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= best)
    named = docs.sparkSession.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, best: int = 10) -> DataFrame:
    """For every item its ``best`` documents: ``item_id, rank, doc_id, score``.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``. A null or empty text has no terms: such a document is
    not counted, such an item has no rows, nor has one whose terms no document holds. Rows of one ``item_id`` (null is
    one too) are one item with all their terms. Repeated documents are ranked as often as they are there; equal scores
    go by ``doc_id``, null last. Other columns are not read. Texts of any length are cut piece by piece.
    """
    prepare(docs.sparkSession)
    each = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(item_terms(F.col("text"))).alias("term"))
    gathered = each.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [_block(docs, ids, terms, best) for ids, terms in _blocks(gathered)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if len(found) > 1:
        found = [stored(f) for f in found]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


#: The query's result for SQL.
SQL = r"""
with words as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents),
facts as (select count(*) as n_docs, sum(len(w)) as n_terms from words where len(w) > 0),
tfs as (select r, doc_id, n, term, count(*) as tf
        from (select r, doc_id, len(w) as n, unnest(w) as term from words) group by all),
items as (
    select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark),
weights as (
    select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as weight
    from (select term, count(*) as df from tfs group by term), facts),
scored as (
    select item_id, r, doc_id,
           cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + cast((90 * n * n_docs) // n_terms as bigint))))) as bigint) as score
    from items join weights using (term) join tfs using (term), facts group by all)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from scored where score > 0)
where rank <= 10
"""
