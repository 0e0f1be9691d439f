"""What changed between full snapshots of a table.

Method. Every key gets a persistent ordinal: keys are range-partitioned, numbered inside
their partition and shifted by the sizes of the partitions before, and keys of an earlier
dictionary keep theirs. The keys present in one snapshot are a bitmap, compressed by blocks
of ordinals: blocks without keys do not exist, a block of few keys is their sorted positions
and a fuller one its bits, whichever is smaller. AND-NOT of neighbouring bitmaps gives
additions and removals; the columns of a snapshot's block stay Arrow vectors in the order of
their ordinals, and for the keys in both snapshots they are aligned by ordinal and compared
vector by vector. A block is streamed snapshot by snapshot, so a task holds two snapshots of
one block, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.stage import Stages

SPAN = 4096  # ordinals of a block
KEYS_PER_PART = 200_000


class Bitmap:
    """The set positions of a block of SPAN ordinals: sorted 16-bit positions while they take less
    room than the bits, else the bits."""

    __slots__ = ("held", "packed")

    def __init__(self, held: np.ndarray, packed: bool):
        self.held, self.packed = held, packed

    @classmethod
    def of(cls, positions: np.ndarray) -> Bitmap:
        """From sorted distinct positions."""
        if 2 * len(positions) < SPAN // 8:
            return cls(positions.astype(np.uint16), False)
        flat = np.zeros(SPAN, bool)
        flat[positions] = True
        return cls(np.packbits(flat), True)

    def positions(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.held)) if self.packed else self.held.astype(np.int64)

    def _meet(self, other: Bitmap, inside: bool) -> Bitmap:
        if self.packed and other.packed:
            return Bitmap(self.held & (other.held if inside else ~other.held), True)
        mine = self.positions()
        if other.packed:
            has = (other.held[mine >> 3] >> (7 - (mine & 7)).astype(np.uint8)) & 1 == 1
        else:
            has = np.isin(mine, other.held, assume_unique=True)
        return Bitmap.of(mine[has == inside])

    def __and__(self, other: Bitmap) -> Bitmap:
        return self._meet(other, True)

    def without(self, other: Bitmap) -> Bitmap:
        """AND-NOT."""
        return self._meet(other, False)


def as_set(array: Column) -> Column:
    """An array compared as a set, null like empty."""
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(array, F.array().cast("array<string>")))))


def _number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = 0
    for d in batches:
        yield d.assign(pos=np.arange(n, n + len(d)))
        n += len(d)


def ordinals(keys: DataFrame, names: list[str], stages: Stages, known: DataFrame | None = None) -> DataFrame:
    """Distinct keys with a bigint ``ordinal``. Keys of ``known`` (the same columns) keep theirs;
    new keys follow behind the largest."""
    start = 0
    if known is not None:
        on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names]
        keys = keys.alias("a").join(known.alias("b"), on, "left_anti")
        most = known.agg(F.max("ordinal")).first()[0]
        start = 0 if most is None else most + 1
    parts = max(1, -(-keys.count() // KEYS_PER_PART))
    kinds = dict(keys.dtypes)
    ranged = keys.repartitionByRange(parts, *names).sortWithinPartitions(*names).withColumn("part", F.spark_partition_id())
    numbered = stages.write(ranged.mapInPandas(_number, ", ".join(f"{c} {kinds[c]}" for c in names) + ", part int, pos long"), "keys")
    sizes = numbered.groupBy("part").count()  # a row for each partition
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    new = numbered.join(before, "part").select(*names, (F.col("before") + F.col("pos") + F.lit(start)).alias("ordinal"))
    return new if known is None else known.select(*names, "ordinal").unionByName(new)


class _Block(NamedTuple):
    """One snapshot of one block of ordinals: its bitmap, and where its rows begin in the chunk."""

    block: int
    entity: str | None
    no: int
    prev: int | None
    next: int | None
    at: np.ndarray
    keys: Bitmap
    row: int

    def rows(self, positions: np.ndarray) -> np.ndarray:
        return self.row + np.searchsorted(self.at, positions)


EMPTY = Bitmap.of(np.zeros(0, np.int64))
FOUND = pa.schema([("entity", pa.string()), ("no", pa.int64()), ("ordinal", pa.int64()), ("change", pa.string()), ("fields", pa.list_(pa.string()))])


def _differ(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Where two vectors differ; null differs from every value."""
    unequal = pc.fill_null(pc.not_equal(x, y), False)
    return pc.or_(unequal, pc.xor(pc.is_null(x), pc.is_null(y))).to_numpy(zero_copy_only=False)


class _Changes:
    """What the bitmaps of neighbouring snapshots tell, gathered for a chunk of rows, so that the
    vectors of all its blocks are aligned and compared at once."""

    def __init__(self):
        self.lone: list[tuple[_Block, int, np.ndarray, str]] = []
        self.both: list[tuple[_Block, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, a: _Block | None, b: _Block | None, no: int) -> None:
        before, after = a.keys if a else EMPTY, b.keys if b else EMPTY
        for change, bitmap in (("removed", before.without(after)), ("added", after.without(before))):
            at = bitmap.positions()
            if len(at):
                self.lone.append((a or b, no, at, change))
        if a and b and len(at := (before & after).positions()):
            self.both.append((b, at, a.rows(at), b.rows(at)))

    def batches(self, rows: pa.Table, fields: list[str]) -> Iterator[pa.RecordBatch]:
        if self.lone:
            yield self._batch([x[0] for x in self.lone], [x[1] for x in self.lone], [x[2] for x in self.lone], [x[3] for x in self.lone], None)
        if self.both:
            blocks, at, i, j = zip(*self.both, strict=True)
            i, j = pa.array(np.concatenate(i)), pa.array(np.concatenate(j))
            differ = np.stack([_differ(rows.column(f).take(i).combine_chunks(), rows.column(f).take(j).combine_chunks()) for f in fields])
            any_ = differ.any(axis=0)
            parts = np.split(any_, np.cumsum([len(x) for x in at])[:-1])
            names = np.array([f[2:] for f in fields], object)
            named = [names[d].tolist() for d in differ.T[any_]]
            yield self._batch(blocks, [b.no for b in blocks], [x[keep] for x, keep in zip(at, parts, strict=True)], ["changed"] * len(blocks), named)

    @staticmethod
    def _batch(blocks, nos: list[int], at: list[np.ndarray], changes: list[str], named: list | None) -> pa.RecordBatch:
        which = pa.array(np.repeat(np.arange(len(at)), [len(x) for x in at]))
        spread = lambda values, kind: pa.array(values, kind).take(which)
        ordinal = spread([b.block * SPAN for b in blocks], pa.int64()).to_numpy() + np.concatenate(at)
        columns = [spread([b.entity for b in blocks], pa.string()), spread(nos, pa.int64()), pa.array(ordinal, pa.int64()), spread(changes, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(ordinal), FOUND.field("fields").type) if named is None else pa.array(named, FOUND.field("fields").type)], schema=FOUND)


def _stretches(rows: pa.Table) -> tuple[pa.Table, list[_Block]]:
    """The rows without those whose ordinal a snapshot has already (the first is the latest), and
    the stretch of each (block, entity, snapshot)."""
    entity = rows.column("entity").combine_chunks().dictionary_encode(null_encoding="encode")
    code, names = entity.indices.to_numpy(), entity.dictionary.to_pylist()
    block, no, ordinal = (rows.column(c).to_numpy() for c in ("block", "no", "ordinal"))
    new = np.r_[True, (block[1:] != block[:-1]) | (no[1:] != no[:-1]) | (code[1:] != code[:-1])]
    first = new | np.r_[True, ordinal[1:] != ordinal[:-1]]
    if not first.all():
        rows, new, block, no, ordinal, code = rows.filter(pa.array(first)), *(x[first] for x in (new, block, no, ordinal, code))
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(new))
    prev, nxt = (rows.column(c).take(pa.array(starts)).to_pylist() for c in ("prev", "next"))
    at = ordinal - block * SPAN
    return rows, [_Block(int(block[s]), names[code[s]], int(no[s]), p, n, at[s:e], Bitmap.of(at[s:e]), int(s)) for s, e, p, n in zip(starts, ends, prev, nxt, strict=True)]


def _stream(batches: Iterator[pa.RecordBatch], fields: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, entity, snapshot, ordinal). From chunk to chunk the last complete
    stretch, which has been compared already, and the one after it are carried on."""
    kept: pa.Table | None = None
    compared = False  # whether the first stretch of what is kept has been

    def chunk(rows: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table, bool]:
        rows, blocks = _stretches(rows)
        changes, old = _Changes(), None
        for i, new in enumerate(blocks if last else blocks[:-1]):
            if old is not None and (old.block, old.entity, old.next) == (new.block, new.entity, new.no):
                changes.add(old, new, new.no)
            else:  # the keys of a block may all be missing from a snapshot
                if old is not None and old.next is not None:
                    changes.add(old, None, old.next)
                if new.prev is not None and not (compared and i == 0):
                    changes.add(None, new, new.no)
            old = new
        if last and old.next is not None:
            changes.add(old, None, old.next)
        return list(changes.batches(rows, fields)), rows.slice(old.row if old else 0), old is not None

    for d in batches:
        if d.num_rows:
            new = pa.Table.from_batches([d])
            out, kept, compared = chunk(new if kept is None else pa.concat_tables([kept, new]), False)
            yield from out
    if kept is not None:
        yield from chunk(kept, True)[0]
    yield pa.RecordBatch.from_pylist([], schema=FOUND)


def _keyed(df: DataFrame, entity: str, number: str, key: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    on = ["entity", *[f"k_{n}" for n in key]]
    rows = df.filter(F.col(number).isNotNull()).select(F.col(entity).cast("string").alias("entity"), *[c.cast("string").alias(f"k_{n}") for n, c in key.items()])
    return rows.select(on).distinct(), on


def key_ordinals(df: DataFrame, entity: str, number: str, key: dict[str, Column], known: DataFrame | None = None) -> DataFrame:
    """The dictionary of the keys of ``df``: entity, a column k_NAME for each key, ordinal. Stored
    and given as ``known`` it keeps the ordinals of its keys when later snapshots come."""
    keys, on = _keyed(df, entity, number, key)
    stages = Stages(df.sparkSession, "ordinals")
    return stages.write(ordinals(keys, on, stages, known), "dictionary")


def snapshot_changes(df: DataFrame, entity: str, number: str, key: dict[str, Column], fields: dict[str, Column], at: str, known: DataFrame | None = None) -> DataFrame:
    """Records added, removed or changed between neighbouring snapshots of each entity.

    ``number`` orders the snapshots of an entity; neighbours are those that were delivered.
    ``key`` names the string columns that identify a record, ``fields`` the values compared
    (cast to string; null differs from every value). Of several rows with one key in one
    snapshot the one with the latest ``at`` counts. Rows without a number belong to no
    snapshot and are left out; a null entity is an entity of its own; null key parts are keys.
    An empty table and an entity with one snapshot give nothing. Only the named columns are
    read. Result: entity, no (the later snapshot), the key columns, change (added, removed,
    changed), fields (the names of those that differ, null unless changed).
    """
    spark = df.sparkSession
    stages = Stages(spark, "snapshots")
    names = list(key)
    rows = df.filter(F.col(number).isNotNull()).select(F.col(entity).cast("string").alias("entity"), F.col(number).cast("long").alias("no"), F.col(at).alias("at"), *[c.cast("string").alias(f"k_{n}") for n, c in key.items()], *[c.cast("string").alias(f"f_{n}") for n, c in fields.items()])
    on = ["entity", *[f"k_{n}" for n in names]]
    codes = ordinals(rows.select(on).distinct(), on, stages, known)
    w = Window.partitionBy("entity").orderBy("no")
    given = rows.select("entity", "no").distinct().withColumns({"prev": F.lag("no").over(w), "next": F.lead("no").over(w)})
    same = lambda a, b, cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    full = rows.alias("r").join(codes.alias("c"), same("r", "c", on)).join(given.alias("g"), same("r", "g", ["entity", "no"]))
    full = full.select(F.floor(F.col("ordinal") / SPAN).alias("block"), "r.entity", "r.no", "ordinal", "prev", "next", "at", *[f"f_{n}" for n in fields])
    full = full.repartition("block", "entity").sortWithinPartitions("block", "entity", "no", "ordinal", F.desc("at"))
    found = full.drop("at").mapInArrow(partial(_stream, fields=[f"f_{n}" for n in fields]), "entity string, no long, ordinal long, change string, fields array<string>")
    return found.join(codes.drop("entity"), "ordinal").select("entity", "no", *[F.col(f"k_{n}").alias(n) for n in names], "change", "fields")
