"""Partitioned files that batches replace part by part, each beside the older one: `day=2024-01-05/batch=12`.

The rows before a batch are those of the highest number below its own. So a batch that is repeated, because the first
try was lost on the way, starts from the same rows and replaces what that left. Batches must come one after another.

A folder costs time whatever it holds, so numbered parts in a row share one, `span=3/batch=12`, if a batch has most of
them. It must have them all then (`whole_spans`), so that of a part's own folder and its span's the newer one counts.
What a batch has of other spans goes to one folder each too, if these are many parts: `some=3/batch=12/has=00000000000001c0`
names by its bits which parts of the span are there. So a batch makes folders for the spans of its parts, and rewrites no
other parts.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vendaria.sources.scratch import directories, discard, make_folder

BATCH = "batch"
SPAN = "span"
SOME, HAS = "some", "has"
#: A span has 2^6 parts.
SPAN_BITS = 6
MOST = (1 << SPAN_BITS) // 2
#: From so many parts on the names of all parts' folders are listed at once, and parts of a span share a folder.
MANY = 64


class Places(NamedTuple):
    """Where the newest rows of parts are."""

    own: list[str]
    newest: dict[int, int]
    in_span: list[int]
    #: Of a part, the batch and the bits of the folder that it shares with some others of its span.
    in_some: dict[int, tuple[int, int]]


def whole_spans(parts: Sequence[int | None]) -> list[int | None]:
    """The numbered parts, and the others of those spans that most parts are among them."""
    times = Counter(p >> SPAN_BITS for p in parts if p is not None)
    full = {span for span, n in times.items() if n >= MOST}
    others = [p for p in parts if p is None or p >> SPAN_BITS not in full]
    return others + [p for span in sorted(full) for p in _parts_of(span)]


def read_parts(
    spark: SparkSession, path: str, schema: StructType, part_col: str, parts: Sequence, before: int
) -> DataFrame:
    """The rows of some parts before a batch. Only the folders of these parts are listed and read.

    Older rows of them go: no batch starts from them any more.
    """
    names = {name for name, _ in directories(spark, path)} if len(parts) > MANY else None

    def earlier(name: str) -> list[int]:
        return [b for b in _batches(spark, f"{path}/{name}") if b < before] if names is None or name in names else []

    newest, some = {}, {}
    if _is_numbered(schema, part_col):
        for span in {p >> SPAN_BITS for p in parts if p is not None}:
            batches = earlier(f"{SPAN}={span}")
            for old in batches[:-1]:
                discard(spark, f"{path}/{SPAN}={span}/{BATCH}={old}")
            newest |= {span: batches[-1]} if batches else {}
            if names is None or f"{SOME}={span}" in names:
                some |= _newest_of_some(spark, path, span, newest.get(span, -1), before)
    places = Places([], newest, [], {})
    for part in parts:
        name = _folder(part_col, part)
        batches = earlier(name)
        shared = -1 if part is None else max(newest.get(part >> SPAN_BITS, -1) if newest else -1, some.get(part, (-1,))[0])
        own = [b for b in batches if b > shared][-1:]
        if own:
            places.own.append(f"{path}/{name}/{BATCH}={own[0]}")
        elif part in some:
            places.in_some[part] = some[part]
        elif shared >= 0:
            places.in_span.append(part)
        for old in batches:
            if old not in own:
                discard(spark, f"{path}/{name}/{BATCH}={old}")
    return _read(spark, path, schema, part_col, places)


def read_all_parts(spark: SparkSession, path: str, schema: StructType, part_col: str) -> DataFrame:
    """The newest rows of all parts, between two batches."""
    folders = {name: _batches(spark, folder) for name, folder in directories(spark, path)}
    last = {name: batches[-1] for name, batches in folders.items() if batches}
    newest = {int(name.partition("=")[2]): b for name, b in last.items() if name.startswith(f"{SPAN}=")}
    some = {}
    for name in last:
        if name.startswith(f"{SOME}="):
            span = int(name.partition("=")[2])
            some |= _newest_of_some(spark, path, span, newest.get(span, -1))
    found, own = [], set()
    for name, batch in last.items():
        column, _, part = name.partition("=")
        if column != part_col:
            continue
        number = int(part) if (newest or some) and part.lstrip("-").isdigit() else None
        if number is None or batch > max(newest.get(number >> SPAN_BITS, -1), some.get(number, (-1,))[0]):
            found.append(f"{path}/{name}/{BATCH}={batch}")
            own.add(number)
    in_span = [p for span in newest for p in _parts_of(span) if p not in own and p not in some]
    in_some = {p: where for p, where in some.items() if p not in own}
    return _read(spark, path, schema, part_col, Places(found, newest, in_span, in_some))


def write_parts(rows: DataFrame, path: str, part_col: str, batch_id: int, parts: Sequence = ()) -> None:
    """Each part whole, beside its older ones. Those of `parts` that have no rows become empty.

    Numbered rows are read more than once, so they should be stored.
    """
    spark = rows.sparkSession
    if _is_numbered(rows.schema, part_col):
        span = F.shiftright(part_col, SPAN_BITS)
        bits = F.bit_or(F.expr(f"shiftleft(1L, CAST(`{part_col}` & {(1 << SPAN_BITS) - 1} AS INT))"))
        held = {row[0]: row[1] for row in rows.groupBy(span.alias(SPAN)).agg(bits).collect()}
        spans = {s: bits & (1 << (1 << SPAN_BITS)) - 1 for s, bits in held.items() if s is not None}
        full = [s for s, bits in spans.items() if bits.bit_count() >= MOST]
        others = [(s, f"{bits:016x}") for s, bits in spans.items() if bits.bit_count() < MOST]
        if full:
            shared = F.coalesce(span.isin(full), F.lit(False))
            # In order, so that the files can be read by part.
            _write(rows.filter(shared).withColumn(SPAN, span), path, SPAN, batch_id, [part_col])
            rows = rows.filter(~shared)
        if sum(int(bits, 16).bit_count() for _, bits in others) > MANY:
            for s, _ in others:
                discard(spark, f"{path}/{SOME}={s}/{BATCH}={batch_id}")
            names = spark.createDataFrame(others, f"{SOME} long, {HAS} string")
            some = rows.withColumn(SOME, span).join(F.broadcast(names), SOME)
            _write(some, path, SOME, batch_id, [part_col], [HAS])
            rows, others = rows.filter(F.col(part_col).isNull()), []
        if others or None in held:
            _write(rows, path, part_col, batch_id)
    else:
        _write(rows, path, part_col, batch_id)
    for part in parts:
        make_folder(spark, f"{path}/{_folder(part_col, part)}/{BATCH}={batch_id}")


def _write(
    rows: DataFrame, path: str, part_col: str, batch_id: int, order: Sequence[str] = (), below: Sequence[str] = ()
) -> None:
    rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", F.col(part_col))
    if order:
        rows = rows.sortWithinPartitions(part_col, BATCH, *below, *order)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part_col, BATCH, *below)
        .parquet(path)
    )


def _read(spark: SparkSession, path: str, schema: StructType, part_col: str, places: Places) -> DataFrame:
    """The rows in folders of parts, of the parts in their span's newest batch, and of those that share with some others."""
    rows = []
    if places.own:
        rows.append(_stored(spark, path, schema, part_col, places.own))
    times = Counter(p >> SPAN_BITS for p in places.in_span)
    for whole in (True, False):
        spans = {span for span, n in times.items() if (n == 1 << SPAN_BITS) == whole}
        if spans:
            folders = [f"{path}/{SPAN}={s}/{BATCH}={places.newest[s]}" for s in sorted(spans)]
            shared = _stored(spark, path, schema, SPAN, folders)
            wanted = [p for p in places.in_span if p >> SPAN_BITS in spans]
            rows.append(shared if whole else shared.filter(F.col(part_col).isin(wanted)))
    folders = defaultdict(list)
    for part, (batch, bits) in places.in_some.items():
        folders[part >> SPAN_BITS, batch, bits].append(part)
    for whole in (True, False):
        some = {of: parts for of, parts in folders.items() if (len(parts) == of[2].bit_count()) == whole}
        if some:
            names = [f"{path}/{SOME}={s}/{BATCH}={batch}/{HAS}={bits:016x}" for s, batch, bits in sorted(some)]
            shared = _stored(spark, path, schema, SOME, names, [BATCH])
            if not whole:  # others of their parts are newer elsewhere
                wanted = [(part, of[1]) for of, parts in some.items() for part in parts]
                wanted = spark.createDataFrame(wanted, StructType([schema[part_col], StructField(BATCH, LongType())]))
                shared = shared.join(F.broadcast(wanted), [part_col, BATCH], "left_semi")
            rows.append(shared.select(*schema.names))
    if not rows:
        return spark.createDataFrame([], schema)
    first, *others = rows
    for more in others:
        first = first.unionByName(more)
    return first


def _stored(
    spark: SparkSession, path: str, schema: StructType, folder_col: str, folders: list[str], more: Sequence[str] = ()
) -> DataFrame:
    in_path = [schema[folder_col] if folder_col in schema.names else StructField(folder_col, LongType())]
    in_path += [StructField(BATCH, LongType()), *([StructField(HAS, StringType())] if folder_col == SOME else [])]
    stored = StructType([*[f for f in schema if f.name != folder_col], *in_path])
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*schema.names, *more)


def _newest_of_some(
    spark: SparkSession, path: str, span: int, newest: int, before: int | None = None
) -> dict[int, tuple[int, int]]:
    """(batch, bits) of the newest folder that each part shares with some others, where that is newer than `newest`.

    With `before`, of earlier batches only, and folders whose parts are all in newer shared ones go.
    """
    found, covered = {}, 0
    for batch in reversed(_batches(spark, f"{path}/{SOME}={span}")):
        if before is not None and batch >= before:
            continue
        folder = f"{path}/{SOME}={span}/{BATCH}={batch}"
        bits = 0
        for name, _ in directories(spark, folder) if batch > newest else []:
            bits = int(name.partition("=")[2], 16)
            found = {p: (batch, bits) for p in _parts_of(span) if bits >> (p & len(_parts_of(span)) - 1) & 1} | found
        if before is not None and not bits & ~covered:
            discard(spark, folder)
        covered |= bits
    return found


def _is_numbered(schema: StructType, part_col: str) -> bool:
    return isinstance(schema[part_col].dataType, LongType)


def _parts_of(span: int) -> range:
    return range(span << SPAN_BITS, (span + 1) << SPAN_BITS)


def _batches(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.partition("=")[2]) for name, _ in directories(spark, folder))


def _folder(part_col: str, part) -> str:
    return f"{part_col}={'__HIVE_DEFAULT_PARTITION__' if part is None else part}"
