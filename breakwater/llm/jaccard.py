"""N-gram Jaccard join with adaptive multi-match prefixes.

Two sets whose overlap is at least o share at least l of the first ``size - o + l`` tokens of each, in any one
order of all tokens. Every document chooses its own l, lengthening its prefix while the estimated cost of its
candidates falls; a pair must then share as many prefix tokens as the smaller of the two l. The order puts tokens
that a count sketch of all documents finds rare first. Documents with equal sets are one node throughout.

Links are found in three passes. The first links every node to the least node of the prefix token it shares most with,
verifies those pairs and joins them into components. The second does so in tokens that several components still share,
with up to ``HUBS`` nodes of each, chosen by hash: of those that may link a node takes the nearest and the first. So a
group of near copies becomes one component also where most of its pairs miss the threshold. The third joins the rows of
one token across two components, and verifies what is left. Pairs inside a component change no component, so the
components are exact; no group of copies is expanded into its pairs. From the second pass on, tokens that the same
nodes hold are one token of their number, so a pair is met once for all of them.

Filters stand inside the joins, so that pairs which cannot link are never made into rows. One is by parities: a set's
tokens are dealt to bits and a bit tells whether an odd number of them fell on it. A token that only one of two sets has
turns one bit around, so two sets have at least as many different tokens as their parities have different bits. In a
group whose members all just miss the threshold, this comparison is still made for every two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from breakwater.llm import graph
from breakwater.llm.bitmap import bitmap_of, mark, might_hold
from breakwater.llm.common import shuffle_width, steady_scans, stored
from breakwater.llm.words import WordNumbers, shingles, split_words

# Parameters. The sketch has a fixed size and only steers how much work is done: its counters, slices and the first
# level of their sums; tokens gathered before they are counted.
COUNTERS, SLICES, FAN, GATHERED = 1 << 18, 16, 32, 500_000
# The greatest l, and costs of a prefix row, of a row met on the way and of a verified candidate.
MOST_MATCHES, ROW_COST, MEET_COST, VERIFY_COST = 4, 1.0, 1.0, 20.0
# Pairs of one node verified in one task before it is split; 64-bit numbers of a set's parities; nodes of a token that
# the others of it are compared with before components are; nodes of a token up to which they meet without parities.
STAR, PARITIES, HUBS, PLAIN = 500, 16, 48, 8


class Tokens:
    """The set of a document: distinct shingles of its words, A-Z in lower case, as rising 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.numbers = words, WordNumbers()

    def of(self, text: str | None) -> np.ndarray:
        return np.unique(shingles(self.numbers.of(split_words(text or "", lower=True)), self.words))


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(23) & np.uint64(COUNTERS - 1)).astype(np.int64)


def _batch(columns: list[tuple[str, object, list]]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(v, t) for _, t, v in columns], [n for n, _, _ in columns])


# -- first scan: sets and the sketch ----------------------------------------------------------------------------

_FIRST = "doc_id long, size int, digest binary, slice int, part int, counts binary"


def _survey(words: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        tokens, counts, waiting, gathered = Tokens(words), np.zeros(COUNTERS, np.int64), [], 0
        for batch in batches:
            ids, sizes, digests = batch.column(0).to_pylist(), [], []
            for text in batch.column(1):
                own = tokens.of(text.as_py())
                sizes.append(len(own))
                digests.append(_digest(own))
                waiting.append(_counter(own))
                gathered += len(own)
                if gathered > GATHERED:
                    counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, gathered = [], 0
            none = [None] * len(ids)
            yield _batch([("doc_id", pa.int64(), ids), ("size", pa.int32(), sizes), ("digest", pa.binary(), digests),
                          ("slice", pa.int32(), none), ("part", pa.int32(), none), ("counts", pa.binary(), none)])
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        pieces = [zstandard.compress(p.tobytes(), 1) for p in np.split(counts, SLICES)]
        none, part = [None] * SLICES, TaskContext.get().partitionId() % FAN
        yield _batch([("doc_id", pa.int64(), none), ("size", pa.int32(), none), ("digest", pa.binary(), none),
                      ("slice", pa.int32(), list(range(SLICES))), ("part", pa.int32(), [part] * SLICES), ("counts", pa.binary(), pieces)])

    return run


def _summed(batches: Iterable) -> Iterator:
    """Counts of one slice after the other added up; rows come sorted by ``slice, part``."""
    import pyarrow as pa
    import zstandard

    at, total = None, None

    def done():
        packed = zstandard.compress(total.tobytes(), 1)
        return _batch([("slice", pa.int32(), [at[0]]), ("part", pa.int32(), [at[1]]), ("counts", pa.binary(), [packed])])

    for batch in batches:
        for row in batch.to_pylist():
            if at != (row["slice"], row["part"]):
                if at is not None:
                    yield done()
                at, total = (row["slice"], row["part"]), np.zeros(COUNTERS // SLICES, np.int64)
            total += np.frombuffer(zstandard.decompress(row["counts"]), np.int64)
    if at is not None:
        yield done()


def _sketch(first: DataFrame, tasks: int) -> np.ndarray:
    """How often each counter was met, over all documents; ``COUNTERS`` numbers whatever the corpus."""
    import zstandard

    rows = first.where(F.col("counts").isNotNull()).select("slice", "part", "counts")
    schema = "slice int, part int, counts binary"
    for width in (FAN, 1):
        dealt = rows.withColumn("part", F.pmod("part", F.lit(width)))
        dealt = dealt.repartitionById(tasks, F.pmod(F.col("slice") * width + F.col("part"), F.lit(tasks)))
        rows = dealt.sortWithinPartitions("slice", "part").mapInArrow(_summed, schema)
    pieces = {r.slice: np.frombuffer(zstandard.decompress(r.counts), np.int64) for r in rows.collect()}
    return np.concatenate([pieces.get(i, np.zeros(COUNTERS // SLICES, np.int64)) for i in range(SLICES)])


# -- second scan: prefixes --------------------------------------------------------------------------------------


def least_overlap(size: int, num: int, den: int) -> int:
    """Tokens that a set of this size shares at least with any set it links to."""
    return -(-size * num // den)


def choose(others: np.ndarray, size: int, overlap: int) -> int:
    """The l of least estimated cost. ``others``: documents met by each token, in prefix order."""
    best, least = 1, np.inf
    met = np.cumsum(others)
    for matches in range(1, min(MOST_MATCHES, overlap) + 1):
        length = size - overlap + matches
        meets = met[length - 1]
        cost = ROW_COST * length + MEET_COST * meets + VERIFY_COST * meets / matches
        if cost < least:
            best, least = matches, cost
    return best


def _parities(tokens: np.ndarray) -> np.ndarray:
    """Bits that an odd number of the tokens falls on."""
    fell = np.bincount((tokens >> np.uint64(7) & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES)
    return np.packbits((fell & 1).astype(np.uint8)).view(np.int64)


def _prefixes(words: int, num: int, den: int, sketch: np.ndarray):
    total = int(sketch.sum())

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        tokens = Tokens(words)
        for batch in batches:
            out: dict[str, list] = {"digest": [], "row": [], "size": [], "matches": [], "parity": [], "prefix": []}
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = tokens.of(text.as_py())
                if not len(own):
                    continue
                met = sketch[_counter(own)]
                others = np.maximum(0.0, met - 1 - (total - met) / (COUNTERS - 1))
                order = np.lexsort((own, np.floor(np.log2(others + 1))))
                overlap = least_overlap(len(own), num, den)
                matches = choose(others[order], len(own), overlap)
                out["digest"].append(_digest(own))
                out["row"].append(row)
                out["size"].append(len(own))
                out["matches"].append(matches)
                out["parity"].append(_parities(own))
                out["prefix"].append(own[order[: len(own) - overlap + matches]].view(np.int64))
            kinds = {"digest": pa.binary(), "row": pa.int64(), "size": pa.int32(), "matches": pa.int32(), "parity": pa.list_(pa.int64()), "prefix": pa.list_(pa.int64())}
            yield _batch([(name, kinds[name], values) for name, values in out.items()])

    return run


# -- third scan: sets of the nodes to verify --------------------------------------------------------------------


def _sets(words: int, asked: np.ndarray):
    """``row, text`` to ``row, tokens`` of the rows that may be asked for."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        tokens = Tokens(words)
        for batch in batches:
            wanted = np.flatnonzero(might_hold(asked, batch.column(2).to_numpy()))
            rows, texts = batch.column(0).to_numpy()[wanted], batch.column(1)
            sets = [tokens.of(texts[i].as_py()).tobytes() for i in wanted.tolist()]
            yield _batch([("row", pa.int64(), rows), ("tokens", pa.binary(), sets)])

    return run


def _compare(num: int, den: int):
    """Rows sorted so that a node's own set comes before the sets to compare it with."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        node = own = None
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                other = np.frombuffer(row["tokens"], np.uint64)
                if row["b"] is None:
                    node, own = row["a"], other
                    continue
                if node != row["a"]:
                    raise ValueError("a set is missing; store the documents first")
                shared = len(np.intersect1d(own, other, assume_unique=True))
                if den * shared >= num * (len(own) + len(other) - shared):
                    a.append(row["a"])
                    b.append(row["b"])
            yield _batch([("a", pa.int64(), a), ("b", pa.int64(), b)])

    return run


# -- the operator -----------------------------------------------------------------------------------------------


_SIZE_BIT, _PLACE_BIT = 34, 4


def _unpacked() -> list[Column]:
    """Size of the node, place of the token and l, out of one number."""
    packed = F.col("packed")
    return [
        F.shiftright(packed, _SIZE_BIT).alias("size"),
        F.shiftright(packed, _PLACE_BIT).bitwiseAND(F.lit((1 << _SIZE_BIT - _PLACE_BIT) - 1)).alias("place"),
        packed.bitwiseAND(F.lit((1 << _PLACE_BIT) - 1)).alias("matches"),
    ]


class Join:
    """One run of the join over ``docs``; see :func:`linked`. A node is the least row of the documents with one set."""

    def __init__(self, docs: DataFrame, words: int, num: int, den: int):
        steady_scans(docs)
        self.texts = docs.select(F.monotonically_increasing_id().alias("row"), "text")
        self.words, self.num, self.den = words, num, den
        self.width = shuffle_width(docs.sparkSession)
        first = stored(docs.select("doc_id", "text").mapInArrow(_survey(words), _FIRST))
        self.members = first.where(F.col("counts").isNull()).select("doc_id", "size", "digest")
        prefixes = self.texts.mapInArrow(
            _prefixes(words, num, den, _sketch(first, self.width)), "digest binary, row long, size int, matches int, parity array<long>, prefix array<long>"
        )
        sets = prefixes.groupBy("digest").agg(F.min("row").alias("node"), *[F.any_value(c).alias(c) for c in ("size", "matches", "parity", "prefix")])
        self.nodes = stored(sets)

    def shared_tokens(self) -> DataFrame:
        """Prefix rows of tokens that more than one node has, with the least of those nodes."""
        exploded = self.nodes.select("node", "size", "matches", F.posexplode("prefix").alias("place", "token"))
        size, place = F.shiftleft(F.col("size").cast("long"), _SIZE_BIT), F.shiftleft(F.col("place").cast("long"), _PLACE_BIT)
        rows = exploded.select("token", "node", size.bitwiseOR(place).bitwiseOR(F.col("matches").cast("long")).alias("packed"))
        held = Window.partitionBy("token")
        counted = rows.select("*", F.count("*").over(held).alias("n"), F.min("node").over(held).alias("hub"))
        return stored(counted.where("n > 1").drop("n"))

    def _fits(self, size: str, other: str) -> Column:
        smaller, larger = F.least(size, other), F.greatest(size, other)
        return smaller * self.den >= larger * self.num

    def _needed(self, size: str, other: str) -> Column:
        """The least overlap with which two sets of these sizes link."""
        return F.ceil((F.col(size) + F.col(other)) * F.lit(self.num) / F.lit(self.num + self.den) - F.lit(1e-9))

    def _different(self) -> Column:
        """Bits in which the parities differ."""
        return sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"other_p{i}"))) for i in range(PARITIES)), F.lit(0))

    def _may_link(self) -> Column:
        """Whether the parities differ in no more bits than the sets of a link may have different tokens."""
        return self._different() * F.lit(self.num + self.den) <= (F.col("size") + F.col("other_size")) * F.lit(self.den - self.num)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose sets link. Of the two, ``a`` is the one that may be in many pairs.

        Pairs of other sizes, or whose parities differ too much, cannot link and go first. A set of the others is cut from its text again, moves once to meet the pairs that ask for it and once to meet the
        other set; a node of many pairs is split, its set repeated.
        """
        sides = self.nodes.select("node", "size", *self._parity())
        names = ["size", *(f"p{i}" for i in range(PARITIES))]
        known = pairs.join(sides.toDF("a", *names), "a").join(sides.toDF("b", *(f"other_{n}" for n in names)), "b")
        pairs = stored(known.where(self._fits("size", "other_size") & self._may_link()).select("a", "b"))
        splits = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("int").alias("splits"))
        own = splits.select(
            F.col("a").alias("row"), "a", F.lit(None).cast("long").alias("b"), F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("salt")
        )
        others = pairs.join(splits, "a").select(
            F.col("b").alias("row"), "a", "b", F.pmod(F.xxhash64("b"), F.col("splits")).cast("int").alias("salt")
        )
        requests = stored(own.unionByName(others))
        asked = bitmap_of(requests.select(mark(F.xxhash64("row")).alias("mark")), self.width)
        sets = self.texts.select("row", "text", F.xxhash64("row").alias("mark")).mapInArrow(
            _sets(self.words, asked), "row long, tokens binary"
        )
        met = requests.join(sets, "row").select("a", "salt", "b", "tokens")
        ordered = met.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        return stored(ordered.select("a", "b", "tokens").mapInArrow(_compare(self.num, self.den), "a long, b long"))

    def stars(self, shared: DataFrame) -> DataFrame:
        """Every node with one of the nodes that lead its tokens, the one it shares most with."""
        pairs = shared.where("hub <> node").groupBy("hub", "node").agg(F.count("*").alias("n"))
        most = Window.partitionBy("node").orderBy(F.desc("n"), "hub")
        best = pairs.withColumn("rank", F.row_number().over(most)).where("rank = 1").select(F.col("hub").alias("a"), F.col("node").alias("b"))
        return best

    def _parity(self) -> list[Column]:
        return [F.col("parity")[i].alias(f"p{i}") for i in range(PARITIES)]

    def still_mixed(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """Rows of tokens whose nodes are of several components, with ``component`` and the token's rows ``n``."""
        labelled = rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        held = Window.partitionBy("token")
        ends = labelled.select(
            "*", F.min("component").over(held).alias("lo"), F.max("component").over(held).alias("hi"), F.count("*").over(held).alias("n")
        )
        return ends.where("lo <> hi").drop("lo", "hi")

    def classes(self, mixed: DataFrame) -> DataFrame:
        """Rows of :meth:`still_mixed` with the tokens that the same nodes hold as one: ``weight`` tokens, the first ``place``.

        Holders are told apart by a hash; tokens that it takes for one meet more pairs than they must, never fewer.
        """
        holders = F.bit_xor(F.xxhash64("node")).over(Window.partitionBy("token"))
        rows = mixed.select(holders.alias("holders"), "node", "component", "n", *_unpacked())
        first = [F.any_value(c).alias(c) for c in ("component", "size", "matches")]
        found = rows.groupBy("holders", "n", "node").agg(F.min("place").alias("place"), F.count("*").alias("weight"), *first)
        return found.withColumnRenamed("holders", "token")

    def _met(self, left: DataFrame, right: DataFrame, other: Column) -> DataFrame:
        """Rows of one token that may link: of two components, of fitting sizes and places, of near parities if they have them."""
        own = [c for c in left.columns if c != "token"]
        right = right.select("token", *[F.col(c).alias(f"other_{c}") for c in own], *[c for c in right.columns if c not in (*own, "token")])
        tail = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
        near = self._may_link() if "p0" in own else F.lit(True)
        return left.join(right, "token").where(
            (F.col("component") != F.col("other_component"))
            & other
            & self._fits("size", "other_size")
            & (tail >= self._needed("size", "other_size") - F.least("matches", "other_matches") + 1)
            & near
        )

    def _with_parity(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.nodes.select("node", *self._parity()), "node")

    def near_hubs(self, mixed: DataFrame) -> DataFrame:
        """Every node of a token of many with the nearest and the first of the token's chosen nodes that may link with it."""
        by_hash = Window.partitionBy("token").orderBy(F.xxhash64("node"), "node")
        large = mixed.where(F.col("n") > HUBS).drop("n")
        hubs = large.withColumn("turn", F.row_number().over(by_hash)).where(F.col("turn") <= HUBS).drop("turn")
        met = self._met(self._with_parity(large), self._with_parity(hubs), F.lit(True))
        nearest = F.min(F.struct(self._different().alias("different"), "other_node"))["other_node"]
        first = F.min(F.struct(F.xxhash64("other_node").alias("hash"), "other_node"))["other_node"]
        chosen = met.groupBy("node").agg(F.array_distinct(F.array(nearest, first)).alias("hubs"))
        pairs = chosen.select(F.explode("hubs").alias("a"), F.col("node").alias("b"))
        # Two hubs may have chosen each other.
        return pairs.groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.*")

    def across(self, mixed: DataFrame, tried: DataFrame) -> DataFrame:
        """Pairs of two components that share enough prefix tokens, unless tried before.

        In tokens of few rows these are few; rows of the others take their parities to the join.
        """
        by_size = Window.partitionBy("token").orderBy(F.desc("n"), "component")
        main = mixed.groupBy("token", "component").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(by_size))
        main = main.where("rank = 1").select("token", F.col("component").alias("main"))
        rows = mixed.join(main, "token").withColumn("is_main", F.col("component") == F.col("main")).drop("main")
        once = F.col("other_is_main") | (F.col("node") < F.col("other_node"))
        met = []
        for kind in (rows.where(F.col("n") <= PLAIN).drop("n"), self._with_parity(rows.where(F.col("n") > PLAIN).drop("n"))):
            found = self._met(kind.where("not is_main"), kind, once)
            enough = F.least("matches", "other_matches").alias("enough")
            weight = F.greatest("weight", "other_weight").alias("weight")
            met.append(found.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"), enough, weight))
        pairs = met[0].unionByName(met[1]).groupBy("a", "b").agg(F.sum("weight").alias("n"), F.any_value("enough").alias("enough"))
        before = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return pairs.where("n >= enough").select("a", "b").join(before, ["a", "b"], "left_anti")

    def run(self) -> DataFrame:
        """``node, component`` of every node that is linked."""
        shared = self.shared_tokens()
        tried = stored(self.stars(shared))
        found = stored(graph.components(self.verified(tried)))
        mixed = stored(self.classes(self.still_mixed(shared, found)))
        near = stored(self.near_hubs(mixed))
        # Components of components: their stars stand for the links that made them.
        found = stored(graph.components(self.verified(near).unionByName(_stars(found))))
        left = stored(self.still_mixed(mixed.drop("component", "n"), found))
        more = self.verified(self.across(left, tried.unionByName(near)))
        return graph.components(more.unionByName(_stars(found)))


def _stars(found: DataFrame) -> DataFrame:
    """Components as links to their least nodes."""
    return found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def linked(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id``, linked where ``den * intersection >= num * union``.

    ``component_id`` is the smallest ``doc_id`` that links reach. A text of fewer words than a shingle is one
    shingle; null and empty texts have none and stand alone. A null ``doc_id`` is smaller than none: a component
    of such documents alone has a null id. Repeated rows are members each. Other columns are not read; ``docs``
    must give the same rows when read again.
    """
    join = Join(docs, words, num, den)
    least = join.members.where("size > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    labels = join.run()
    named = join.nodes.select("node", "digest").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = stored(named.join(least, "digest").select("digest", "component", "least"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    # Salted, for a set or component that a third of all documents share.
    by_digest = known.join(smallest, "component").select("digest", "component_id", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    rows = join.members.where("size > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int"))
    inside = rows.join(by_digest, ["digest", "salt"]).select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id")
    alone = join.members.where("size = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return inside.unionByName(alone)


def representatives(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each linked component, the first; columns stay as they are.

    Rows without a word (null texts too) are linked with nothing and all stay. Repeated rows are one component, so
    one of them stays. ``docs`` must give the same rows when read again.
    """
    join = Join(docs, words, num, den)
    dropped = join.run().where("node <> component").select("node")
    keep = join.nodes.select("node").join(dropped, "node", "left_anti").select(F.col("node").alias("row"))
    bare = join.texts.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select("row")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    whole = docs.select(doc, F.monotonically_increasing_id().alias("row"))
    return whole.join(keep.unionByName(bare), "row", "left_semi").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


#: The query's result for SQL: every pair that shares a shingle is counted, components by walking the links.
SQL = r"""
with recursive words as (
    select row_number() over () as r, doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as w
    from documents),
sets as (select r, doc_id, list_distinct(case when len(w) between 1 and 3 then [array_to_string(w, ' ')]
                else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] end) as s from words),
flat as (select r, unnest(s) as g from sets),
shared as (select a.r as x, b.r as y, count(*) as n from flat a join flat b on a.g = b.g and a.r < b.r group by all),
links as (select x, y from shared join sets p on p.r = x join sets q on q.r = y
          where 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
linked as (select x, y from links union all select y, x from links),
reach(r, other) as (select r, r from sets union select reach.r, y from reach join linked on x = other)
select m.doc_id, cast(len(m.s) as bigint) as n_shingles, least.component_id
from sets m join (select reach.r, min(doc_id) as component_id from reach join sets on sets.r = other group by all) least
     on least.r = m.r
"""
