"""Exact Jaccard self-join of word n-gram sets by PartEnum signatures.

Sizes fall into bands [l, l / similarity]; similar sets are in one band or in
neighbouring ones, and two sets of an instance (a band and the one below) differ in at
most k elements. The element domain is split by hash into n1 partitions of three parts.
If n1 is at least (k + 1) / 2, similar sets have a partition in which at most one element
differs, so two of its three parts agree: a set's signatures are all pairs of parts.

Signatures of two empty parts would throw all small sets together and are left out.
n1 has a few partitions more than needed, so a set loses no partner by that unless it
and the partner have more such partitions than these; both then also have the
elements of a prefix filter as signatures, which finds any similar pair.

Sets that share a signature are candidates: small buckets become pairs, which repeat
from bucket to bucket and are kept once, and sizes that rule a pair out drop it at once.
Sets that agree in a passage only would still hang together by chance. So the members
of a bucket are first compared by parity sketches, one bit per hash bin telling whether
the bin holds an odd number of elements: two sets differ in at least as many elements as
their sketches in bits, so no similar pair is lost, and with about a bit per element
nearly all pairs below a similarity of 0.7 go.

What is left hangs together where sets are near copies. Such sets go to one task with
their elements, each once; the task compares the pairs of a bucket that are not in one
group yet, so buckets of near copies cost few comparisons and emit no pairs. Where very
many hang together they are dealt into parts, compared inside a part and, for buckets
that are still in several groups, part by part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kpicast.llm.common import SMALL_SLICE, mix, n_shards, slices, word_hashes
from kpicast.llm.components import components
from kpicast.session import written

WORDS = 5
SIMILAR, OF = 80, 100  # linked if OF * intersection >= SIMILAR * union
SHARD_SIGNATURES = 2 << 20
PART_ELEMENTS, TASK_ELEMENTS = 8 << 20, 2 << 20
BROADCAST_ROWS = 1 << 19
PAIRED = 8  # buckets of at most so many sets become pairs
SIEVED = 4096  # buckets of more sets are not sieved, and all their pairs stay candidates
FILTER_BITS = 24
_BUCKET = "bucket long, sid long, n long, members long"
_PLACE = np.random.default_rng(905).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_GOLD = 0x9E3779B97F4A7C15


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of every text. A text with fewer
    words is one n-gram; a null, empty or blank text is the empty set."""
    hashes, counts = word_hashes(column)
    place = _PLACE[:words]
    grams = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for j in range(words):
        grams += hashes[j : j + len(grams)] * place[j]
    grams = mix(grams ^ np.uint64(words))
    at = 0
    for n in counts.tolist():
        if n >= words:
            yield np.unique(grams[at : at + n - words + 1])
        elif n:
            yield mix((hashes[at : at + n] * _PLACE[:n]).sum(keepdims=True) ^ np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)
        at += n


def set_id(elements: np.ndarray) -> int:
    """A 64-bit name of a set, from two sums over its elements; -1 if it is empty.
    Equal sets have equal names, so copies are one set from here on."""
    if not len(elements):
        return -1
    one, two = mix(elements).sum(), mix(elements ^ np.uint64(_GOLD)).sum()
    name = mix(np.array([one], np.uint64) ^ mix(np.array([two + np.uint64(len(elements))], np.uint64)))
    return int(name[0] >> np.uint64(1))


class Bands:
    """Bands of sizes; grown as sizes are met."""

    def __init__(self) -> None:
        self.upto = [0]  # largest size of each band; band 0 is empty

    def of(self, size: int) -> int:
        while self.upto[-1] < size:
            low = self.upto[-1] + 1
            self.upto.append(low * OF // SIMILAR)
        return int(np.searchsorted(self.upto, size))

    def differing(self, band: int) -> int:
        """Most elements by which two similar sets up to this band's sizes differ."""
        while len(self.upto) <= band:
            self.of(self.upto[-1] + 1)
        return 2 * self.upto[band] * (OF - SIMILAR) // (OF + SIMILAR)


_bands = Bands()


def signatures(elements: np.ndarray) -> np.ndarray:
    """64-bit signatures of a set that is not empty."""
    size, out = len(elements), []
    own = _bands.of(size)
    for band in (own, own + 1):
        k = _bands.differing(band)
        tag = np.uint64(band * _GOLD & 0xFFFFFFFFFFFFFFFF)
        if k == 0:
            out.append(mix(np.array([set_id(elements)], np.uint64) ^ tag))
            continue
        needed = (k + 2) // 2
        spare = 0 if k < 8 else 2 + needed // 16
        n1 = needed + spare
        spread = mix(elements ^ tag)
        part = (spread % np.uint64(3 * n1)).astype(np.int64)
        sums = np.zeros(3 * n1, np.uint64)
        np.add.at(sums, part, spread)
        sums = sums.reshape(n1, 3)
        full = np.bincount(part, minlength=3 * n1).reshape(n1, 3) > 0
        pair = sums.sum(1)[:, None] - sums  # all but one part
        some = full.sum(1)[:, None] - full > 0
        name = np.arange(3 * n1, dtype=np.uint64).reshape(n1, 3)
        out.append(mix(pair ^ mix(name ^ tag))[some])
        if (~some).any(1).sum() > spare:
            first = size - -(-size * SIMILAR // OF) + 1
            out.append(mix(elements[:first] ^ mix(np.array([tag ^ np.uint64(1)]))))
    return np.concatenate(out)


def packed(elements: np.ndarray) -> bytes:
    """The top 48 bits of sorted elements, for comparing two sets."""
    return (elements >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def parity(elements: np.ndarray) -> bytes:
    """A bit per bin, a power of two bins and at least as many as elements."""
    bins = max(64, 1 << (len(elements) - 1).bit_length()) if len(elements) else 64
    place = (mix(elements ^ np.uint64(_GOLD >> 1)) & np.uint64(bins - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bins).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_be_similar(size: int, bits: bytes, other_size: int, other_bits: bytes) -> bool:
    """False only if two sets are not similar for certain."""
    if OF * min(size, other_size) < SIMILAR * max(size, other_size):
        return False
    if len(bits) < len(other_bits):
        bits, other_bits = other_bits, bits
    one, two = int.from_bytes(bits, "little"), int.from_bytes(other_bits, "little")
    width = 8 * len(bits)
    while width > 8 * len(other_bits):  # parities of half as many bins
        width //= 2
        one = (one >> width) ^ (one & ((1 << width) - 1))
    return (one ^ two).bit_count() * (OF + SIMILAR) <= (size + other_size) * (OF - SIMILAR)


def _described(docs: DataFrame) -> DataFrame:
    """doc_id, size, name and sketch of every document's set."""
    fields = [T.StructField("n", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("bits", T.BinaryType())]
    schema = T.StructType([docs.schema["doc_id"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SMALL_SLICE):
            sets = [(len(s), set_id(s), parity(s)) for s in shingle_sets(batch.column("text"))]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([s[k] for s in sets], t) for k, t in enumerate(kinds))],
                ["doc_id", "n", "sid", "bits"],
            )

    return docs.mapInArrow(run, schema)


def _dealt_signatures(docs: DataFrame, shards: int) -> DataFrame:
    """Signatures packed by shard: per slice of documents and shard one row of names,
    sizes and counts of sets, and of the low 40 bits of their signatures. A few
    unlike signatures that agree in shard and 40 bits only add candidates, and shards
    grow with the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made, names, sizes = [], [], []
            seen: set[int] = set()
            parts = slices(iter([batch]), size=SMALL_SLICE)
            for elements in (s for part in parts for s in shingle_sets(part.column("text"))):
                name = set_id(elements)
                if name >= 0 and name not in seen:
                    seen.add(name)
                    made.append(signatures(elements))
                    names.append(name)
                    sizes.append(len(elements))
            if not made:
                continue
            owner = np.repeat(np.arange(len(made)), [len(m) for m in made])
            sigs = np.concatenate(made)
            shard = ((sigs >> np.uint64(48)) * np.uint64(shards) >> np.uint64(16)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = []
            names, sizes = np.array(names, np.int64), np.array(sizes, np.int64)
            for s in range(shards):
                own = order[cut[s] : cut[s + 1]]
                if not len(own):
                    continue
                sets, counts = np.unique(owner[own], return_counts=True)
                low = sigs[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                rows.append((s, names[sets].tobytes(), sizes[sets].tobytes(), counts.astype(np.int32).tobytes(), low.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))],
                ["shard", "names", "sizes", "counts", "sigs"],
            )

    return docs.mapInArrow(run, "shard int, names binary, sizes binary, counts binary, sigs binary")


def _buckets(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, sid, n, members: the sets of every signature that several sets of similar
    size have. Small buckets become pairs, and buckets of one shard with equal sets are
    one."""
    parts: dict[int, list] = {}
    for batch in group:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["counts"], np.int32)
            low = np.zeros((len(row["sigs"]) // 5, 8), np.uint8)
            low[:, :5] = np.frombuffer(row["sigs"], np.uint8).reshape(-1, 5)
            names = np.frombuffer(row["names"], np.int64)
            sizes = np.frombuffer(row["sizes"], np.int64)
            parts.setdefault(row["shard"], []).append((low.view("<u8").ravel(), names, sizes, counts))
    for shard, own in parts.items():
        sigs = np.concatenate([p[0] for p in own])
        if len(sigs) <= 1 << 24:  # signature and place in one number sort fastest
            packed = np.sort(sigs << np.uint64(24) | np.arange(len(sigs), dtype=np.uint64))
            order = (packed & np.uint64((1 << 24) - 1)).astype(np.int64)
            packed >>= np.uint64(24)
        else:
            order = np.argsort(sigs)
            packed = sigs[order]
        runs = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1], [True]]))
        many = np.flatnonzero(np.diff(runs) > 1)
        names = np.concatenate([np.repeat(p[1], p[3]) for p in own])
        sizes = np.concatenate([np.repeat(p[2], p[3]) for p in own])
        seen: set[bytes] = set()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for r in many.tolist():
            at = order[runs[r] : runs[r + 1]]
            sid, first = np.unique(names[at], return_index=True)
            if len(sid) < 2:
                continue
            size = sizes[at][first]
            if len(sid) <= PAIRED:
                for i, j in combinations(range(len(sid)), 2):
                    pair = sid[[i, j]]
                    alike = OF * min(size[i], size[j]) >= SIMILAR * max(size[i], size[j])
                    if alike and (key := pair.tobytes()) not in seen:
                        seen.add(key)
                        out.append((pair, size[[i, j]]))
                        held += 2
            else:
                out.append((sid, size))
                held += len(sid)
            if held > 50_000:
                yield _bucket_rows(shard, out)
                out, held = [], 0
        if out:
            yield _bucket_rows(shard, out)


def _bucket_rows(shard: int, out: list) -> pa.RecordBatch:
    sid = np.concatenate([o[0] for o in out])
    # A bucket is named after its members.
    members = [len(o[0]) for o in out]
    begin = np.cumsum(members) - members
    name = np.repeat(np.add.reduceat(mix(sid.astype(np.uint64)), begin) >> np.uint64(1), members)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(name.astype(np.int64)),
            pa.array(sid, pa.int64()),
            pa.array(np.concatenate([o[1] for o in out]), pa.int64()),
            pa.array(np.repeat(members, members), pa.int64()),
        ],
        ["bucket", "sid", "n", "members"],
    )


def _groups_of(members: list[dict]) -> list[list[dict]]:
    """Members of a bucket that hang together by pairs that may be similar."""
    apart: list[list[dict]] = []
    for x in members:
        mine, rest = [x], []
        for group in apart:
            if any(may_be_similar(x["n"], x["bits"], y["n"], y["bits"]) for y in group):
                mine = [*group, *mine]
            else:
                rest.append(group)
        apart = [*rest, mine]
    return [g for g in apart if len(g) > 1]


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets, in order, cut into what sketches leave together."""
    bucket, own = None, []
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def add() -> None:
        for group in _groups_of(own):
            out.append((np.array([x["sid"] for x in group]), np.array([x["n"] for x in group])))

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                add()
                bucket, own = row["bucket"], []
            own.append(row)
        if out:
            yield _bucket_rows(0, out)
            out = []
    add()
    if out:
        yield _bucket_rows(0, out)


def _sieved(buckets: DataFrame, described: DataFrame) -> DataFrame:
    """bucket, sid and n of what sketches leave of the buckets. Buckets of more than
    ``SIEVED`` sets stay as they are, as a task holds a bucket that it sieves."""
    kept = ["bucket", "sid", "n"]
    some = buckets.filter(F.col("members") <= SIEVED).drop("members")
    bits = described.select("sid", "bits").join(some.select("sid").distinct(), "sid", "left_semi")
    bits = bits.groupBy("sid").agg(F.first("bits").alias("bits"))
    drawn = some.join(bits, "sid").repartition("bucket").sortWithinPartitions("bucket", "sid")
    left = drawn.select("bucket", "sid", "n", "bits").mapInArrow(_sieve, _BUCKET)
    return left.select(*kept).unionByName(buckets.filter(F.col("members") > SIEVED).select(*kept)).distinct()


def _bit_filter(ids: DataFrame) -> np.ndarray:
    """Bits of a Bloom filter of fixed size; set bits are gathered as 64-bit words, so
    at most 2 ** (FILTER_BITS - 6) rows reach the driver."""
    bits = 1 << FILTER_BITS
    place = ids.select(F.explode(F.array(*(F.pmod(F.xxhash64("sid", F.lit(k)), F.lit(bits)) for k in range(2)))).alias("p"))
    words = place.groupBy((F.col("p") / 64).cast("long").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(p % 64 AS int)))").alias("b")
    )
    out = np.zeros(bits // 64, np.int64)
    found = words.toPandas()
    out[found["w"].to_numpy()] = found["b"].to_numpy()
    return out


def _sets(docs: DataFrame, described: DataFrame, wanted: DataFrame) -> DataFrame:
    """sid and elements of the wanted sets. A Bloom filter on the ids of one document a
    set drops most others before their elements are written; what it lets through by
    chance finds no pair or repeats a set."""
    one = described.join(wanted, "sid").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    held = docs.sparkSession.sparkContext.broadcast(_bit_filter(one.select(F.col("doc_id").alias("sid"))))
    bits = 1 << FILTER_BITS
    maybe = docs.withColumn("_p", F.array(*(F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(bits)) for k in range(2))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.array(batch.column("_p").to_pylist(), np.int64).reshape(-1, 2)
            inside = ((held.value[places >> 6] >> (places & 63)) & 1).all(1)
            for part in slices(iter([batch.filter(pa.array(inside))]), size=SMALL_SLICE):
                rows = [(set_id(s), packed(s)) for s in shingle_sets(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                    ["doc_id", "sid", "elements"],
                )

    schema = T.StructType([docs.schema["doc_id"], T.StructField("sid", T.LongType()), T.StructField("elements", T.BinaryType())])
    return maybe.mapInArrow(run, schema).select("sid", "elements")


def _compare(buckets: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that join what the buckets of one task join. Pairs of a bucket that
    are in one group already need no comparison; all others are compared once."""
    held = {s: unpacked(e) for s, e in zip(sets["sid"], sets["elements"])}
    up = {s: s for s in held}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    known: set[tuple[int, int]] = set()  # compared and not similar
    links: list[tuple[int, int]] = []
    rows = buckets[buckets["sid"].isin(held)].sort_values(["bucket", "sid"])
    cells = np.flatnonzero(rows["bucket"].diff().ne(0).to_numpy())
    sids, part = rows["sid"].to_list(), rows["part"].to_list()
    crossing = len(set(part)) > 1

    def joined(one: list[int], two: list[int]) -> tuple[int, int] | None:
        """A similar pair between two groups of places, comparing each pair once."""
        for i in one:
            x = held[sids[i]]
            for j in two:
                pair = (sids[i], sids[j]) if sids[i] < sids[j] else (sids[j], sids[i])
                if pair in known or (crossing and part[i] == part[j]):
                    continue
                y = held[sids[j]]
                if OF * min(len(x), len(y)) >= SIMILAR * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if OF * both >= SIMILAR * (len(x) + len(y) - both):
                        return pair
                known.add(pair)
        return None

    for begin, end in zip(cells.tolist(), [*cells.tolist()[1:], len(sids)]):
        groups: dict[int, list[int]] = {}
        for k in range(begin, end):
            groups.setdefault(root(sids[k]), []).append(k)
        if len(groups) == 1:
            continue
        apart: list[list[int]] = []  # groups that no compared pair joins
        for group in sorted(groups.values(), key=len, reverse=True):
            for other in list(apart):
                if (pair := joined(group, other)) is not None:
                    links.append(pair)
                    up[root(pair[1])] = root(pair[0])
                    group = [*other, *group]
                    apart.remove(other)
            apart.append(group)
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _compared(buckets: DataFrame, sets: DataFrame, tasks: DataFrame) -> DataFrame:
    """Links found by tasks that hold sets and what they share: ``tasks`` (a written
    table) has sid, task and part for every task that gets a set. It is three numbers a
    row and broadcast up to ``BROADCAST_ROWS``, so that elements are shuffled once and
    not twice; beyond that the join is a shuffle."""
    left = buckets.join(tasks, "sid").select("task", "bucket", "sid", "part")
    where = tasks.select("sid", F.col("task").alias("at"))
    if where.count() <= BROADCAST_ROWS:
        where = F.broadcast(where)
    right = sets.join(where, "sid").select("at", "sid", "elements")
    return left.groupBy("task").cogroup(right.groupBy("at")).applyInPandas(_compare, "a long, b long")


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(described, grouped): doc_id, n, sid of every row; sid, component of every set
    that is linked to another. Rows with null ids take part under one id."""
    docs = docs.select("doc_id", "text")
    described = written(_described(docs), "sets")
    spark = docs.sparkSession
    total = described.agg(F.sum("n")).first()[0] or 0
    shards = n_shards(spark, int(0.8 * total), SHARD_SIGNATURES)
    dealt = _dealt_signatures(docs, shards).repartition(shards, "shard")
    raw = written(dealt.mapInArrow(_buckets, _BUCKET).distinct(), "raw-buckets")
    buckets = written(_sieved(raw, described), "buckets")
    least = buckets.groupBy("bucket").agg(F.min("sid").alias("a"))
    stars = buckets.join(least, "bucket").filter("a < sid").selectExpr("sid AS a", "a AS b").distinct()
    candidates = written(components(stars), "candidates")
    # Candidates that hang together go to one task, or to several if they are many.
    sizes = written(buckets.select("sid", "n").distinct(), "sizes")
    weighed = candidates.withColumnRenamed("id", "sid").join(sizes, "sid")
    cut = F.ceil(F.sum("n") / PART_ELEMENTS).cast("int").alias("parts")
    placed = (
        weighed.join(weighed.groupBy("component").agg(cut), "component")
        .withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
        .drop("n")
    )
    placed = written(placed, "placed")
    many = sizes.agg(F.sum("n")).first()[0] or 0
    tasks = n_shards(spark, many, TASK_ELEMENTS)
    task = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(tasks)).cast("int").alias("task")
    wanted = buckets.select("sid").distinct()
    sets = _sets(docs, described, wanted)
    once = placed.select("sid", task("component", "part"), F.lit(0).alias("part"))
    links = _compared(buckets, sets, once)
    links = written(links, "links")
    # Buckets over several parts that are not in one group yet: parts two by two.
    grouped = components(links)
    wide = placed.filter("parts > 1")
    if not wide.isEmpty():
        groups = written(grouped.selectExpr("id AS sid", "component AS c"), "groups")
        named = buckets.join(wide.select("sid"), "sid").join(groups, "sid", "left")
        open_ = named.groupBy("bucket").agg(F.min(F.coalesce("c", "sid")).alias("l"), F.max(F.coalesce("c", "sid")).alias("m"))
        rest = written(named.join(open_.filter("l < m"), "bucket").select("bucket", "sid"), "open")
        # A set goes to the pairs of parts that its open buckets span, and no others.
        at = rest.join(wide, "sid").select("bucket", "sid", "component", "part")
        spans = at.groupBy("bucket").agg(F.collect_set("part").alias("spanned"))
        other = F.explode(F.array_except("spanned", F.array("part"))).alias("other")
        pairs = at.join(spans, "bucket").select("sid", "component", "part", other)
        key = ("component", F.least("part", "other"), F.greatest("part", "other"))
        pairs = written(pairs.select("sid", F.xxhash64(*key).alias("task"), "part").distinct(), "pairs")
        more = _compared(rest, _sets(docs, described, pairs.select("sid").distinct()), pairs)
        grouped = components(links.unionByName(written(more, "links")))
    return described, grouped


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    Documents without words are linked with nothing; rows that repeat an id share its
    component, and a null id is the smallest of its component only if no other is
    there. Extra columns are left out.
    """
    described, grouped = join(docs)
    grouped = written(grouped.selectExpr("id AS sid", "component"), "groups")
    named = described.join(grouped, "sid", "left").withColumn(
        "_c", F.when(F.col("n") > 0, F.coalesce("component", "sid"))
    )
    named = written(named.select("doc_id", "n", "_c"), "named")
    least = named.filter("_c IS NOT NULL").groupBy("_c").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "_c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
