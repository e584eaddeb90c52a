"""Flatten nested JSON text into key/value rows, maps, wide tables and CSV lines.

Each document is flattened where its row is: nothing is shuffled until a caller
asks for the set of all keys. Parsing and flattening run as one Arrow batch
function. The same done with VARIANT casts and higher-order functions copies the
values below every container it opens and was measured about five times slower.

Key rules: an object inside an object passes on the prefix it got and adds no
name of its own; an array inside an object starts a new prefix, its name; inside
an array, nested arrays add their 0-based position, objects and scalars their
1-based position. JSON nulls and the text "null" of object members are dropped.
Where two values get the same key the one with the greatest path stays, compared
name by name and position by position.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from loglens.functions import flatten
from loglens.functions.parsing import strip_commas
from loglens.operators.lookup import lookup_join
from loglens.operators.ordering import running_totals
from loglens.session import checkpointed, written

# The batch function travels with its task, so executors need no copy of this package.
for _module in (flatten, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

# Columns of a wide table; the default of Spark's own pivot. CSV files have no such bound.
MAX_COLUMNS = 10_000
# Bytes of a CSV file, and keys that one chunk of its header holds.
CSV_PART_BYTES = 128 * 1024 * 1024
HEADER_KEYS = 1_000


def _flatten_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows ``(doc_id, text)`` to one row per object, or one with a reason."""
    decoder = flatten.make_decoder()
    texts = batch.column(1).to_pylist()
    source, elements, reasons, collisions = [], [], [], []
    offsets, keys, values = [0], [], []
    for i, text in enumerate(texts):
        objects, reason = flatten.flat_objects(text, decoder)
        if reason is not None:
            source.append(i)
            elements.append(None)
            reasons.append(reason)
            collisions.append(None)
            offsets.append(len(keys))
            continue
        escaped = "\\ud" in text or "\\uD" in text
        for element, (flat, lost) in enumerate(objects):
            if escaped:
                flat = {flatten.whole_characters(k): flatten.whole_characters(v) for k, v in flat.items()}
            source.append(i)
            elements.append(element)
            reasons.append(None)
            collisions.append(lost)
            keys.extend(flat)
            values.extend(flat.values())
            offsets.append(len(keys))
    rows = pa.array(source, pa.int64())
    good = pa.array([r is None for r in reasons], pa.bool_())
    kept_text = pa.compute.if_else(good, pa.scalar(None, pa.string()), batch.column(1).take(rows))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(rows),
            kept_text,
            pa.array(elements, pa.int32()),
            pa.MapArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string())
            ),
            pa.array(collisions, pa.int32()),
            pa.array(reasons, pa.string()),
        ],
        names=["doc_id", "text", "element", "flat", "collisions", "reason"],
    )


# Input handled at once, which bounds the memory of a task on long documents.
_PIECE_BYTES = 32 * 1024 * 1024


def _flatten_batches(batches):
    for batch in batches:
        pieces = batch.nbytes // _PIECE_BYTES + 1
        step = max(1, batch.num_rows // pieces)
        for start in range(0, batch.num_rows, step):
            yield _flatten_batch(batch.slice(start, step))


def flatten_json(df: DataFrame, doc_id: str, text: str):
    """``(doc_id, element, flat MAP<STRING,STRING>, collisions)`` and quarantined rows.

    An object gives one row, an array of objects one row per element. Everything
    else is quarantined as ``(doc_id, text, reason)``.
    """
    schema = StructType(
        [
            StructField("doc_id", df.schema[doc_id].dataType),
            StructField("text", StringType()),
            StructField("element", IntegerType()),
            StructField("flat", MapType(StringType(), StringType())),
            StructField("collisions", IntegerType()),
            StructField("reason", StringType()),
        ]
    )
    made = df.select(doc_id, text).mapInArrow(_flatten_batches, schema)
    good = made.filter(F.col("reason").isNull()).select(
        F.col("doc_id").alias(doc_id), "element", "flat", "collisions"
    )
    bad = made.filter(F.col("reason").isNotNull()).select(
        F.col("doc_id").alias(doc_id), F.col("text").alias(text), "reason"
    )
    return good, bad


def flat_long(flat: DataFrame) -> DataFrame:
    """One row per key."""
    others = [c for c in flat.columns if c not in ("flat", "collisions")]
    keys = F.map_entries("flat")
    return flat.select(*others, F.inline(keys))


def all_keys(flat: DataFrame) -> DataFrame:
    """One row holding the sorted union of all keys."""
    keys = flat.select(F.explode(F.map_keys("flat")).alias("key")).distinct()
    return keys.agg(F.array_sort(F.collect_set("key")).alias("keys"))


def _cell(key: Column) -> Column:
    return strip_commas(F.try_element_at("flat", key))


def flat_wide(flat: DataFrame, keys=None) -> DataFrame:
    """One column per key in sorted order, "" where a row lacks it, commas removed.

    A carried column whose name is also a key, in any case, gets underscores put before
    it. Columns need names on the driver. More keys than ``MAX_COLUMNS`` are
    refused; :func:`csv_lines` takes any number.
    """
    keys = wide_keys(flat, keys)
    taken = {key.lower() for key in keys}
    carried = []
    for name in flat.columns:
        if name not in ("flat", "collisions"):
            new = name
            while new.lower() in taken:
                new = f"_{new}"
            carried.append(F.col(name).alias(new))
    return flat.select(*carried, *cells(keys))


def cells(keys):
    """One output column per key."""
    return [_cell(F.lit(key)).alias(key) for key in keys]


def wide_keys(flat: DataFrame, keys=None):
    """The given keys, or the sorted union of all keys if that many can be columns."""
    if keys is None:
        names = flat.select(F.explode(F.map_keys("flat")).alias("key")).distinct()
        keys = sorted(row["key"] for row in names.take(MAX_COLUMNS + 1))
    if len(keys) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} keys: use csv_lines")
    return keys


def csv_lines(flat: DataFrame, doc_id: str, single_task_rows=None) -> DataFrame:
    """``(line_no, line)``: the header is line 0, documents follow in order."""
    keys = all_keys(flat)
    header = keys.select(
        F.lit(0).cast("bigint").alias("line_no"), F.array_join("keys", ",").alias("line")
    )
    cells = F.transform("_keys", _cell)
    lines = flat.withColumn("_keys", keys.scalar()).select(
        doc_id, "element", F.array_join(cells, ",").alias("line")
    )
    numbered = running_totals(
        lines,
        [F.asc(doc_id), F.asc("element")],
        {"line_no": F.lit(1).cast("bigint")},
        single_task_rows=single_task_rows,
    )
    return header.unionByName(numbered.select("line_no", "line"))


def _quoted(text: Column) -> Column:
    """A CSV cell, quoted where it has to be."""
    inside = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    special = text.rlike('[",\r\n]')
    return F.when(special, F.concat(F.lit('"'), inside, F.lit('"'))).otherwise(text)


def numbered_keys(flat: DataFrame, single_task_rows=None) -> DataFrame:
    """``(key, number)`` of all keys in sorted order, from 1."""
    keys = checkpointed(flat.select(F.explode(F.map_keys("flat")).alias("key")).distinct())
    one = {"number": F.lit(1).cast("bigint")}
    return running_totals(keys, [F.asc("key")], one, single_task_rows=single_task_rows)


def csv_parts(
    flat: DataFrame, part_bytes: int = CSV_PART_BYTES, single_task_rows=None
) -> DataFrame:
    """Lines that, in the order of each partition, are CSV files with a header.

    ``flat`` should be a stored table: it is read more than once.
    """
    keys = written(numbered_keys(flat, single_task_rows), "csv-keys")
    n_keys = keys.count()
    rows = written(flat.select("flat").withColumn("row", F.monotonically_increasing_id()), "csv-rows")
    sizes = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.length(F.to_json("flat")).cast("bigint")).alias("bytes"),
    ).first()
    # A line has a comma for every key, whatever it holds.
    whole = (sizes["bytes"] or 0) + sizes["rows"] * n_keys
    parts = max(1, min(sizes["rows"], -(-whole // part_bytes)))

    members = rows.select("row", F.explode("flat").alias("key", "value"))
    placed = lookup_join(members, keys, "key", salt_by=("row", "key"))
    filled = placed.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("number", "value"))).alias("cells")
    )
    before = F.concat(F.array(F.lit(1).cast("bigint")), F.transform("cells", lambda c: c["number"]))
    texts = F.zip_with(
        F.col("cells"),
        F.slice(before, 1, F.size("cells")),
        lambda cell, last: F.concat(
            F.repeat(F.lit(","), (cell["number"] - last).cast("int")),
            _quoted(strip_commas(cell["value"])),
        ),
    )
    behind = (F.lit(n_keys) - F.element_at(before, -1)).cast("int")
    line = F.concat(F.array_join(texts, ""), F.repeat(F.lit(","), behind))
    empty = F.repeat(F.lit(","), F.lit(max(0, n_keys - 1)))
    lines = rows.select("row").join(filled.select("row", line.alias("line")), "row", "left")
    lines = lines.select("row", F.coalesce("line", empty).alias("line"))
    # The only cell of a line needs quotes to be seen.
    lines = lines.withColumn("line", F.when(F.col("line") == "", '""').otherwise(F.col("line")))

    # Chunks first: one task then joins texts, not keys. The header is as long as a line.
    chunk = F.floor((F.col("number") - 1) / HEADER_KEYS)
    chunks = keys.groupBy(chunk.alias("place")).agg(
        F.array_sort(F.collect_list(F.struct("number", "key"))).alias("keys")
    )
    names = F.array_join(F.transform("keys", lambda k: _quoted(k["key"])), ",")
    joined = chunks.select(F.struct("place", names.alias("names")).alias("chunk")).agg(
        F.array_sort(F.collect_list("chunk")).alias("chunks")
    )
    header = joined.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias("place"),
        F.array_join(F.transform("chunks", lambda c: c["names"]), ",").alias("value"),
    )
    body = lines.select(
        F.pmod(F.col("row") + F.shiftright("row", 33), F.lit(parts)).cast("int").alias("part"),
        F.lit(1).alias("kind"),
        F.col("row").alias("place"),
        F.col("line").alias("value"),
    )
    return (
        header.unionByName(body)
        .repartitionById(parts, "part")
        .sortWithinPartitions("kind", "place")
        .select("value")
    )
