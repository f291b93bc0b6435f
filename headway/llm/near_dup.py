"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

1. Every document gets its set of word shingles, a fingerprint of that set, and a SuperMinHash signature.
2. Equal sets form a class; its smallest id stands for it from here on, so exact copies cost nothing more.
3. Signatures are cut into bands. Representatives with an equal band share a bucket, whose smallest id leads.
4. Each member is compared with its bucket's leader on the full sets. Those links give components.
5. A member that is in another component than its leader is compared with the bucket's other members, in
   blocks of bounded size and within the task, so that no pair is written. A pair is looked at in the first
   band that it shares, and its sets only if the signatures agree within five standard deviations. Signatures
   alone go to the blocks first; only members that agree with another one there get their texts sent after them.
6. All links give the components.

With 32 bands of 5 registers, a pair of similarity 0.8 shares no band with a probability of 3e-6, and the
signature test of step 5 refuses it with one of 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, drop_tables, shared_dir, stored, told
from .components import block_matches, components, small
from .superminhash import signatures
from .textkit import U64, mix, shingles, words


@dataclass(frozen=True)
class NearDup:
    """``words`` in a shingle; documents are linked at ``percent`` per cent of Jaccard similarity or more."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    #: Members, and shingles, of one block of step 5.
    block_members: int = 1024
    block_shingles: int = 500_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> float:
        s = self.percent / 100
        return s - 5 * (s * (1 - s) / self.registers) ** 0.5

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        shared = block_matches(a, b)
        return 100 * shared >= self.percent * (len(a) + len(b) - shared)


def _sketches(batches: Iterator[pa.RecordBatch], p: NearDup) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        sets, bounds = shingles(words(batch.column("text"), lower=True), p.words)
        registers = signatures(sets, bounds, p.registers)
        with np.errstate(over="ignore"):
            sig = mix(registers).astype(np.uint16)  # unequal registers agree in 16 bits once in 65,536 times
        parts = [sets[bounds[i] : bounds[i + 1]].tobytes() for i in range(batch.num_rows)]
        cols = {
            "doc_id": batch.column("doc_id"),
            "n_shingles": pa.array(np.diff(bounds), pa.int64()),
            "fingerprint": pa.array([blake2b(x, digest_size=16).digest() for x in parts], pa.binary()),
            "sig": pa.array([row.tobytes() for row in sig], pa.binary()),
        }
        yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


_SKETCH = "doc_id long, n_shingles long, fingerprint binary, sig binary"


def _sets(texts: pa.Array, p: NearDup) -> list[np.ndarray]:
    """Each text's set, a chunk of texts at a time."""
    out = []
    for piece in chunks([pa.RecordBatch.from_arrays([texts], ["text"])], "text"):
        sets, bounds = shingles(words(piece.column("text"), lower=True), p.words)
        out += [sets[bounds[i] : bounds[i + 1]] for i in range(piece.num_rows)]
    return out


def _verify(p: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "left"):
            sides = zip(_sets(batch.column("left"), p), _sets(batch.column("right"), p), strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([p.linked(x, y) for x, y in sides], pa.bool_()))

    return run


_MEMBER = "key long, band int, x int, y int, rep long, n_shingles long, component long, open boolean, sig binary"


def _block(p: NearDup, with_text: bool):
    """One block of one bucket, its open documents against the members: those that agree in signature with any, or with their texts the links."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        band = key[1].as_py()
        rows = rows.combine_chunks()
        column = lambda c: pa.concat_arrays(rows.column(c).chunks) if rows.num_rows else pa.array([], rows.schema.field(c).type)
        sig = np.frombuffer(b"".join(column("sig").to_pylist()), np.uint16).reshape(rows.num_rows, p.bands, p.rows)
        ids, comp, open_, sizes = (column(c).to_numpy(zero_copy_only=False) for c in ("rep", "component", "open", "n_shingles"))
        sets = _sets(column("text"), p) if with_text else []
        members, found, wanted = np.flatnonzero(~open_), [], np.zeros(rows.num_rows, bool)
        for u in np.flatnonzero(open_):
            near = members[(comp[members] != comp[u]) & (100 * np.minimum(sizes[members], sizes[u]) >= p.percent * np.maximum(sizes[members], sizes[u]))]
            same = sig[near] == sig[u]
            near = near[(same.mean(axis=(1, 2)) >= p.least_agreement) & (same.all(axis=2).argmax(axis=1) == band)]
            if not with_text:
                wanted[near] = True
                wanted[u] |= len(near) > 0
                continue
            joined: set[int] = set()
            for m in near.tolist():
                if comp[m] not in joined and p.linked(sets[u], sets[m]):
                    joined.add(comp[m])
                    found.append((ids[u], ids[m]))
        if not with_text:
            return rows.filter(pa.array(wanted))
        return pa.table({c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate("ab")})

    return run


def near_duplicates(docs: DataFrame, p: NearDup = NearDup(), folder: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach, itself included; kept is doc_id = component_id.
    A document without words (a null or empty text too) has no shingle, is linked with nothing and kept.
    Repeated rows get repeated results; rows of one id with different texts are one node with the links of
    all of them. A row without doc_id takes its equals' component, and is never kept. Other columns of
    ``docs`` are ignored. Intermediate tables go to ``folder``, by default a new one below
    ``spark.checkpoint.dir``: sketches of all documents, but texts of none but candidates. Those that the
    result still reads (sketch and classes) stay there.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = stored(docs.mapInArrow(lambda x: _sketches(x, p), _SKETCH), f"{folder}/sketch")

    # Classes of equal sets. Copies are summed up before the shuffle, so a huge class is no hot group.
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = stored(full.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), f"{folder}/classes")
    n_classes = classes.count()

    # Band buckets of representatives, and their leaders.
    width = 2 * p.rows
    band = lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width))).alias("key"))
    reps = full.join(small(classes, n_classes).select("fingerprint", F.col("rep").alias("doc_id")), ["fingerprint", "doc_id"], "left_semi")
    reps = stored(reps.select("doc_id", "n_shingles", "sig"), f"{folder}/reps")
    banded = reps.select(F.col("doc_id").alias("rep"), "n_shingles", F.explode(F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), band)).alias("x")).select("rep", "n_shingles", "x.band", "x.key")
    leaders = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("key", "leader")
    leaders = stored(leaders, f"{folder}/leaders")
    n_leaders = leaders.count()
    shared = told(banded, leaders, ["key"], f"{folder}/shared").where("may").drop("may")  # most keys are of one document and need no shuffle
    members = stored(shared.join(small(leaders, n_leaders), "key"), f"{folder}/members")
    buckets = members.groupBy("key").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.max(F.when(F.col("rep") == F.col("leader"), F.col("n_shingles"))).alias("n_leader"))
    buckets = stored(buckets, f"{folder}/buckets")

    # Candidates' texts.
    wanted = stored(members.select(F.col("rep").alias("doc_id")).distinct(), f"{folder}/wanted")
    n_wanted = wanted.count()
    texts = told(docs, wanted, ["doc_id"], f"{folder}/told").where("may").drop("may").join(small(wanted, n_wanted), "doc_id", "left_semi")
    cand = stored(texts, f"{folder}/candidates")
    if cand.count() > n_wanted:  # some ids come more than once
        cand = stored(cand.dropDuplicates(["doc_id", "text"]), f"{folder}/distinct")

    # Members against leaders.
    close = f"100 * least(n_shingles, n_leader) >= {p.percent} * greatest(n_shingles, n_leader)"
    joined = members.where("rep <> leader").join(small(buckets, n_leaders), "key")
    pairs = stored(joined.where(close).select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct(), f"{folder}/pairs")
    own = cand.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    other = cand.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    half = stored(pairs.join(own, "a"), f"{folder}/half")
    star = stored(half.join(other, "b").select("a", "b", "left", "right").mapInArrow(_verify(p), "a long, b long"), f"{folder}/star")

    # An id with different sets is one node: it is linked with what stands for each of them.
    mark = F.xxhash64("fingerprint")
    many = stored(full.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low < high").select("doc_id"), f"{folder}/many")
    n_many = many.count()
    if n_many:
        own = full.join(small(many, n_many), "doc_id", "left_semi").join(small(classes, n_classes), "fingerprint")
        star = stored(star.unionByName(own.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))), f"{folder}/nodes")

    # What the leaders leave open, in blocks.
    first = components(star, f"{folder}/first")
    n_first = first.count()
    named = members.join(small(buckets.where("members > 2"), n_leaders), "key").join(small(first.withColumnRenamed("node", "rep"), n_first), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    led = named.join(small(first.select(F.col("node").alias("leader"), F.col("component").alias("lead")), n_first), "leader", "left").withColumn("lead", F.coalesce("lead", "leader"))
    led = stored(led.where("rep <> leader").select("key", "band", "rep", "n_shingles", "members", "shingles", "component", (F.col("component") != F.col("lead")).alias("open")), f"{folder}/led")
    opened = led.where("open").groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = lambda n, s: F.ceil(F.greatest(n / p.block_members, s / p.block_shingles, F.lit(1))).cast("int")
    opened = stored(opened.select("key", blocks(F.col("n"), F.col("s")).alias("across")), f"{folder}/opened")
    sides = led.join(small(opened, opened.count()), "key").withColumn("down", blocks(F.col("members"), F.col("shingles")))
    place = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    common = ["key", "band", "rep", "component"]
    down = sides.select(*common, F.lit(False).alias("open"), place(F.col("down")).alias("x"), every(F.col("across")).alias("y"))
    across = sides.where("open").select(*common, F.lit(True).alias("open"), place(F.col("across")).alias("y"), every(F.col("down")).alias("x"))
    grid = stored(down.unionByName(across), f"{folder}/grid")
    placed = stored(grid.select(F.col("rep").alias("doc_id")).distinct(), f"{folder}/placed")
    signed = reps.join(small(placed, placed.count()), "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "n_shingles", "sig")
    cells = ["key", "band", "x", "y"]
    near = grid.join(signed, "rep").select(*(c.split(" ")[0] for c in _MEMBER.split(", ")))
    near = stored(near.groupBy(*cells).applyInArrow(_block(p, False), _MEMBER), f"{folder}/near")
    late = star.limit(0)
    if not near.isEmpty():
        carried = near.join(cand.withColumnRenamed("doc_id", "rep"), "rep")
        late = stored(carried.groupBy(*cells).applyInArrow(_block(p, True), "a long, b long").distinct(), f"{folder}/late")

    found = components(star.unionByName(late), f"{folder}/last")
    classed = classes.join(small(found.withColumnRenamed("node", "rep"), found.count()), "rep", "left").select("fingerprint", F.coalesce("component", "rep").alias("component_id"))
    classed = stored(classed, f"{folder}/classed")
    drop_tables(spark, folder, "reps", "leaders", "shared", "members", "buckets", "wanted", "told", "candidates", "distinct", "pairs", "half", "star", "many", "nodes", "first", "led", "opened", "grid", "placed", "near", "late", "last")
    out = sketch.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("fingerprint")).alias("fingerprint")).join(small(classed, n_classes), "fingerprint", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
