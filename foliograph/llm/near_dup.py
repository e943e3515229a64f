"""Near-duplicate groups by a multi-index Hamming join over minwise signatures.

A text's shingle set becomes ``chunks * per_chunk`` minwise values of 16 bits.
Two signatures differ in some of these values; their number is the signature
distance.  The values are split into chunks.  Any pair at a distance below
``2 * chunks`` has, by pigeonhole, a chunk with at most one differing value,
and enumerating that one error (leaving out each value of the chunk in turn)
gives keys of which the pair shares at least one.  A pair of similarity 0.8
disagrees in a chunk of four by two or more values with probability 0.18, in
all ten chunks with probability 4e-8.

No bucket of a key emits its pairs:

1. Equal sets are one node from the start.
2. Each member is compared with the one smallest member of its buckets with
   which it shares most keys.  This alone joins most of any large group.
3. Buckets that still hold nodes of different components are compared inside
   tasks, in pairs of blocks of bounded size, by signature.  A task emits only
   as many near pairs as connect the same members.  What these connect is a
   family; its full sets are compared in the same way, block by block, and only
   links that join two components come out.

Links are confirmed on full shingle sets.  Texts of the compared nodes are
found by a broadcast of their ids up to ``BROADCAST_IDS`` ids, by a shuffled
join beyond.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliograph.llm.components import components
from foliograph.llm.shingles import set_batches, signature_batches
from foliograph.llm.textbytes import gather_ranges, mix
from foliograph.session import scratch_path

CHUNKS, PER_CHUNK = 10, 4
BROADCAST_IDS = 400_000
# Members of one block of a bucket.
BLOCK_ROWS = 1_000
# Further minwise values, of 8 bits, that only sharpen the distance; a distance
# above _FAR of all values is 6 deviations beyond similarity 0.8.
EXTRA = 88
_FAR = 53


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def index_keys(sig: np.ndarray, chunks: int = CHUNKS, per_chunk: int = PER_CHUNK) -> np.ndarray:
    """Keys per signature: each chunk without each of its values."""
    sig = sig.astype(np.uint64)
    keys = np.empty((len(sig), chunks * per_chunk), np.uint64)
    for chunk in range(chunks):
        own = sig[:, chunk * per_chunk : (chunk + 1) * per_chunk]
        for left_out in range(per_chunk):
            number = chunk * per_chunk + left_out
            key = np.full(len(sig), number + 1, np.uint64)
            for i in range(per_chunk):
                if i != left_out:
                    key = mix((key << np.uint64(16)) ^ own[:, i] + key)
            keys[:, number] = key
    return keys


def _key_rows(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = index_keys(_unpacked(batch.column(1))[0])
            ids = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["key", "c"])

    return classes.select("c", "sig").mapInArrow(run, "key bigint, c bigint")


def _packed(sig: np.ndarray) -> list[bytes]:
    """Index values in 16 bits, the others in 8."""
    index = CHUNKS * PER_CHUNK
    return [row[:index].tobytes() + row[index:].astype(np.uint8).tobytes() for row in sig]


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    index = 2 * CHUNKS * PER_CHUNK
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), index + EXTRA)
    return np.ascontiguousarray(rows[:, :index]).view(np.uint16), rows[:, index:]


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``id, shingles`` of the wanted ids."""
    found = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    return docs.join(found, "id", "left_semi").mapInArrow(
        lambda b: set_batches(b, shingle), "id bigint, shingles array<bigint>"
    )


def _confirmed(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (c, lead) whose full sets are similar enough."""
    sets = _sets(docs, pairs.select(F.col("c").alias("id")).union(pairs.select(F.col("lead").alias("id"))).distinct(), shingle)
    member = sets.select(F.col("id").alias("c"), F.col("shingles").alias("s_c"))
    lead = sets.select(F.col("id").alias("lead"), F.col("shingles").alias("s_l"))
    narrow = F.broadcast(pairs) if pairs.count() <= BROADCAST_IDS else pairs
    both = member.join(narrow, "c").join(lead, "lead")
    shared = F.size(F.array_intersect("s_c", "s_l"))
    union = F.size("s_c") + F.size("s_l") - shared
    return both.filter(100 * shared >= percent * union).select("c", "lead")


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """Pairs of bounded blocks of each group, every block with every block, sorted together."""
    size = rows.groupBy(group).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    dealt = (
        rows.join(size, group)
        .withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
    )
    others = [c for c in rows.columns if c != group]
    return dealt.select(group, "i", "j", "block", *others).repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def _by_group(batches: Iterator[pa.RecordBatch], links: Callable) -> Iterator[pa.RecordBatch]:
    """Calls ``links(group)`` for each run of rows with equal first three columns."""
    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        edges = _group_edges(held)
        if len(edges) > 2:
            yield _links_of(held, edges[:-1], links)
            held = held.slice(int(edges[-2]))
    if held is not None and len(held):
        yield _links_of(held, _group_edges(held), links)


def _group_edges(batch: pa.RecordBatch) -> np.ndarray:
    key, i, j = (batch.column(k).to_numpy() for k in range(3))
    new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(key)]])


def _links_of(batch: pa.RecordBatch, edges: np.ndarray, links: Callable) -> pa.RecordBatch:
    component = batch.column(5).to_numpy()
    found: list[tuple[int, int]] = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a > 1 and (component[a:b] != component[a]).any():
            found += links(batch.slice(a, b - a))
    c, lead = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(lead, pa.int64())], names=["c", "lead"])


def _near_rows(group: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers of different components whose signatures are near, piece by piece."""
    i, j, block, _, component = (group.column(k).to_numpy() for k in range(1, 6))
    sig, extra = _unpacked(group.column(6))
    rows = np.arange(len(block))
    left, right = (rows, rows) if i[0] == j[0] else (rows[block == i[0]], rows[block == j[0]])
    for at in range(0, len(left), 64):
        part = left[at : at + 64]
        far = np.zeros((len(part), len(right)), np.uint8)
        for k in range(sig.shape[1]):
            far += sig[part, k][:, None] != sig[right, k][None, :]
        x, y = np.nonzero((far <= _FAR) & (component[part][:, None] != component[right][None, :]))
        p, q = part[x], right[y]
        near = far[x, y] + (extra[p] != extra[q]).sum(axis=1) <= _FAR
        yield p[near], q[near]


class _Forest:
    """Union of row numbers; the links that joined two trees."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        p, q = self.root(x), self.root(y)
        if p != q:
            self.up[q] = p
            self.links.append((x, y))


def _near_links(group: pa.RecordBatch) -> list[tuple[int, int]]:
    """Near pairs of a bucket, no more than connect the same members."""
    forest = _Forest(len(group))
    for p, q in _near_rows(group):
        for x, y in zip(p.tolist(), q.tolist()):
            forest.join(x, y)
    c = group.column(4).to_pylist()
    return [(c[x], c[y]) for x, y in forest.links]


def _exact_links(group: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """Confirmed links of near pairs, no more than connect the same components."""
    c, component = group.column(4).to_pylist(), group.column(5).to_pylist()
    forest, heads = _Forest(len(group)), {}
    for row, name in enumerate(component):
        forest.join(heads.setdefault(name, row), row)
    given = len(forest.links)
    sets = group.column(7)
    size = sets.value_lengths().to_numpy().astype(np.int64)
    edge = np.cumsum(size) - size
    distinct, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    mark = np.zeros(len(distinct), np.uint8)
    for p, q in _near_rows(group):
        for x in np.unique(p).tolist():
            own = forest.root(x)
            with_ = np.array([y for y in q[p == x].tolist() if forest.root(y) != own], np.int64)
            if not len(with_):
                continue
            mark[flat[edge[x] : edge[x] + size[x]]] = 1
            hits = mark[flat[gather_ranges(edge[with_], size[with_])]].astype(np.int64)
            shared = np.add.reduceat(hits, np.cumsum(size[with_]) - size[with_])
            mark[flat[edge[x] : edge[x] + size[x]]] = 0
            for y in with_[100 * shared >= percent * (size[x] + size[with_] - shared)].tolist():
                forest.join(x, y)
    return [(c[x], c[y]) for x, y in forest.links[given:]]


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` plus the component of ``node``; a node without links is its own."""
    named = labels.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(named, node, "left").withColumn(name, F.coalesce(name, node))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id_col>, n_shingles, component_id, kept`` per row of ``docs``.

    Linked are documents of which ``percent`` of 100 of the united shingles are
    shared.  ``component_id`` is the smallest id reachable.  Ids are integers.
    A null or wordless text has no shingle and no link.  Rows with one id are
    one document: they share a component.  A row without an id takes part in no
    link; its component is the smallest id with an equal set, or null.  ``kept``
    tells whether the row's id is its component's.  An empty table gives none.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = _stored(
        texts.mapInArrow(
            lambda b: signature_batches(b, shingle, CHUNKS * PER_CHUNK + EXTRA, _packed),
            "id bigint, n_shingles bigint, fp_a bigint, fp_b bigint, sig binary",
        ),
        "neardup-signatures",
    )
    same = ["n_shingles", "fp_a", "fp_b"]
    classes = _stored(
        signed.filter("n_shingles > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("c"), F.min("sig").alias("sig")),
        "neardup-classes",
    )
    # Rows of one id with different texts link their classes.
    held = signed.filter("n_shingles > 0").join(classes.drop("sig"), same).groupBy("id").agg(
        F.min("c").alias("lead"), F.max("c").alias("c"), F.collect_set("c").alias("all")
    )
    versions = held.filter("lead < c").select(F.explode("all").alias("c"), F.col("id").alias("lead"))
    keys = _key_rows(classes)
    leads = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("lead")).filter("n > 1").drop("n")
    shared = _stored(keys.join(leads, "key"), "neardup-shared")

    # One comparison per member: the bucket leader with which it shares most keys.
    first = (
        shared.filter("c <> lead").groupBy("c", "lead").agg(F.count("*").alias("n"))
        .groupBy("c").agg(F.max(F.struct("n", (-F.col("lead")).alias("least"))).alias("best"))
        .select("c", (-F.col("best.least")).alias("lead"))
    )
    tested = _stored(first, "neardup-first")
    links = _stored(_confirmed(texts, tested, shingle, percent).unionByName(versions), "neardup-links-1")
    labels = components(links, "c", "lead")

    open_keys = _labelled(shared.select("key", "c"), labels, "c", "component")
    mixed = open_keys.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b").select("key")
    rows = open_keys.join(mixed, "key", "left_semi").join(classes.select("c", "sig"), "c")
    near = _blocks(rows.select("key", "c", "component", "sig"), "key").mapInArrow(
        lambda b: _by_group(b, _near_links), "c bigint, lead bigint"
    )
    # Members that near pairs connect form a family; the exact check runs inside it.
    families = _stored(components(near, "c", "lead").withColumnRenamed("component", "family"), "neardup-families")
    if not families.isEmpty():
        members = _labelled(families.withColumnRenamed("node", "c"), labels, "c", "component").join(classes.select("c", "sig"), "c")
        sets = _sets(texts, families.select(F.col("node").alias("id")), shingle)
        checked = _blocks(
            members.join(sets.withColumnRenamed("id", "c"), "c").select("family", "c", "component", "sig", "shingles"), "family"
        ).mapInArrow(lambda b: _by_group(b, lambda g: _exact_links(g, percent)), "c bigint, lead bigint")
        labels = components(links.unionByName(checked), "c", "lead")
    labels = _stored(labels, "neardup-labels")

    whole = _labelled(signed.join(classes.drop("sig"), same, "left"), labels, "c", "component")
    component = F.coalesce("component", F.col("id"))
    return whole.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def one_per_group(
    docs: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each near-duplicate group, with all its columns, which may have any names.

    Rows of one id are one document, of which one row stays.  Rows without an
    id stay, as do null and wordless texts, which are linked with nothing.  An
    empty table gives an empty one.
    """
    spark = docs.sparkSession
    judged = near_duplicates(docs, shingle=shingle, percent=percent, id_col=id_col, text_col=text_col)
    path = scratch_path(spark, "neardup-judged")
    judged.filter(F.col(id_col).isNotNull()).groupBy(F.col(f"`{id_col}`").cast("bigint").alias("id")).agg(
        F.every("kept").alias("kept"), F.count("*").alias("n")
    ).filter("not kept or n > 1").write.parquet(path)
    marked = spark.read.parquet(path)  # ids that go, and ids of several rows
    quoted = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.struct(*quoted).alias("row"))
    side = F.broadcast(marked) if marked.count() <= BROADCAST_IDS else marked
    kept = rows.join(side, "id", "left").filter("kept is null or kept")
    once = kept.filter("n is null").select("row")
    if not marked.filter("kept and n > 1").isEmpty():
        several = kept.filter("n > 1").groupBy("id").agg(F.any_value("row").alias("row"))
        once = once.unionByName(several.select("row"))
    return once.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
