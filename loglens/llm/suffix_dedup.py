"""Removal of long repeated byte strings with a run-length suffix index.

A string of ``LENGTH`` bytes that starts at two places is removed at both. Every
such window has an anchor: the leftmost of its least ``GRAM``-byte hashes, which
depends on its bytes only, so equal windows have equal anchors at equal places. The windows
of one anchor are neighbours; the bytes that they cover are its context.

1. A survey of all texts posts the anchors with a digest of their contexts.
2. Anchors that occur once are done. Where an anchor has one context only, all its
   windows repeat. The others, with different contexts, need an index.
3. Contexts of an anchor meet in one block. A block builds the Burrows-Wheeler
   transform of its contexts, keeps its runs with the text positions at run ends,
   and streams matching statistics from them: inside a run, both the neighbour in
   suffix order and the match length follow from the sample before. Matches
   of ``LENGTH`` bytes mark their windows.
4. An anchor with more than ``GROUP`` contexts would not fit a block; its windows are
   grouped by digest instead, pre-aggregated, which no hot anchor can unbalance.

Equal texts are one class; each has the other as its match. Numbers of classes are
64-bit hashes; two texts with one number raise an error that asks for another
``salt``.

Defined results: a null text is empty; texts below ``LENGTH`` bytes lose nothing;
a repeat inside one document counts; rows stay one to one, and rows that repeat a
text lose all of it from ``LENGTH`` bytes on. An empty table gives an empty result.
Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loglens.llm.common import (
    pick,
    ship,
    text_slices,
    texts_of,
    written,
)

LENGTH = 200
GRAM = 64
REACH = LENGTH - GRAM + 1
# Contexts of one anchor that a block takes, and bytes of a block.
GROUP = 4_000
BLOCK_BYTES = 1 << 20
# Text bytes that a step holds; its arrays take about a hundred times that.
SLICE_BYTES = 1 << 20
BROADCAST_BYTES = 32 * 1024 * 1024
SEPARATOR = b"\xff"
PLACE_BITS = np.uint64(28)

_rng = np.random.default_rng(8)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
STEP = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every position."""
    h, size = BYTE_VALUES[data], 1
    while size < GRAM:
        h = h[:-size] * np.uint64(pow(STEP, size, 1 << 64)) + h[size:]
        size *= 2
    return _mixed(h)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbours from every position."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class PrefixDigests:
    """64-bit digests of byte ranges, from running sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = np.ones(n + 1, np.uint64)
        np.cumprod(np.full(n, pow(STEP, -1, 1 << 64), np.uint64), out=self.inverse[1:])
        powers = np.ones(n, np.uint64)
        if n:
            np.cumprod(np.full(n - 1, STEP, np.uint64), out=powers[1:])
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mixed(BYTE_VALUES)[data] * powers, out=self.sums[1:])

    def of(self, start, end):
        return _mixed(
            (self.sums[end] - self.sums[start]) * self.inverse[start]
            + (end - start).astype(np.uint64)
        ).view(np.int64)


def anchors(texts: list[bytes]):
    """``(owner, hash, place, low, high, digest)`` arrays of all anchors.

    ``place`` is the anchor, ``low`` to ``high`` the windows that start there, all
    counted from the start of their text.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(SEPARATOR.join(texts), np.uint8)
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) >= 1 << int(PLACE_BITS):
        raise ValueError("a text of 256 MB or more")
    begin = np.cumsum(sizes + 1) - sizes - 1
    hashed = gram_hashes(data)
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    ranked = (hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64)
    place = (_least(ranked, REACH) & mask).astype(np.int64)
    starts = np.arange(len(place))
    owner = np.searchsorted(begin, starts, side="right") - 1
    inside = starts + LENGTH <= begin[owner] + sizes[owner]
    starts, place, owner = starts[inside], place[inside], owner[inside]
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    low = starts[fresh]
    high = starts[np.append(np.flatnonzero(fresh)[1:] - 1, len(starts) - 1)]
    place, owner = place[fresh], owner[fresh]
    digest = PrefixDigests(data).of(low, high + LENGTH)
    shift = begin[owner]
    return owner, hashed[place].view(np.int64), place - shift, low - shift, high - shift, digest


def class_key(text: bytes, salt: int) -> bytes:
    return hashlib.blake2b(text, digest_size=16, salt=salt.to_bytes(8, "little")).digest()


def _number(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _lists(owner, rows, *columns):
    """Arrow lists by owner, which rises."""
    ends = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(c)) for c in columns]


def _survey(salt):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                texts = [t.encode() for t in texts_of(part, "text")]
                keys = [class_key(t, salt) for t in texts]
                owner, hashed, place, low, high, digest = anchors(texts)
                # A context that repeats within its text is settled here; one stays as
                # the witness for other texts.
                order = np.lexsort((low, digest, hashed, owner))
                same = np.zeros(len(order), bool)
                o, h, d = owner[order], hashed[order], digest[order]
                same[1:] = (o[1:] == o[:-1]) & (h[1:] == h[:-1]) & (d[1:] == d[:-1])
                again = same.copy()
                again[:-1] |= same[1:]
                own = np.sort(order[again])
                keep = np.sort(order[~same])
                rows = len(texts)
                packed = (low << 32) | ((place - low) << 16) | (high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.binary()),
                        pa.array(list(map(_number, keys)), pa.int64()),
                        *_lists(owner[keep], rows, hashed[keep], packed[keep], digest[keep]),
                        *_lists(owner[own], rows, low[own], high[own] + LENGTH),
                    ],
                    names=["key", "node", "hash", "place", "digest", "own_from", "own_to"],
                )

    return run


SURVEY_SCHEMA = (
    "key binary, node bigint, hash array<bigint>, place array<bigint>, digest array<bigint>,"
    " own_from array<bigint>, own_to array<bigint>"
)


# --- the index of a block -----------------------------------------------------------


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from eight-byte words."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    width = 8
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        if rank[order[-1]] == n or width >= 2 * n:
            return order
        after = np.zeros(n, np.uint64)
        after[: n - width] = rank[width:] if width < n else 0
        key = (rank << np.uint64(32)) | after
        width *= 2


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform with the text positions at their ends.

    ``heads`` are text positions of suffixes that start a run, ``before`` the suffix that
    precedes each of them in order (the end of the run before), ``length`` their
    common prefix. Everything else follows from these samples.
    """

    def __init__(self, data: np.ndarray):
        order = suffix_order(data)
        last = data[order - 1]
        head = np.ones(len(order), bool)
        head[1:] = last[1:] != last[:-1]
        # The suffix of the whole text has no byte before it.
        first = int(np.flatnonzero(order == 0)[0])
        head[first] = True
        if first + 1 < len(order):
            head[first + 1] = True
        rank = np.flatnonzero(head)
        at = order[rank]
        previous = np.where(rank > 0, order[rank - 1], -1)
        by_place = np.argsort(at)
        self.heads, self.before = at[by_place], previous[by_place]
        self.length = self._common(data)

    def _common(self, data):
        """Common prefixes of the sampled pairs, eight bytes at a time."""
        n = len(data)
        padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        words = np.zeros(n, np.uint64)
        for i in range(8):
            words = (words << np.uint64(8)) | padded[i : i + n]
        length = np.zeros(len(self.heads), np.int64)
        going = np.flatnonzero(self.before >= 0)
        while len(going):
            a, b = self.heads[going] + length[going], self.before[going] + length[going]
            fits = np.maximum(a, b) + 8 <= n
            equal = np.zeros(len(going), bool)
            equal[fits] = words[a[fits]] == words[b[fits]]
            length[going[equal]] += 8
            ended = going[~equal]
            for _ in range(8):
                a, b = self.heads[ended] + length[ended], self.before[ended] + length[ended]
                fits = np.maximum(a, b) < n
                ended, a, b = ended[fits], a[fits], b[fits]
                ended = ended[data[a] == data[b]]
                length[ended] += 1
            going = going[equal]
        return length

    def matching_statistics(self, n):
        """For each position in text order: its neighbour and their common length."""
        place = np.arange(n)
        sample = np.searchsorted(self.heads, place, side="right") - 1
        gone = place - self.heads[sample]
        return self.before[sample] + gone, np.maximum(self.length[sample] - gone, 0)


def repeated_starts(contexts: list[bytes], length=LENGTH) -> list[np.ndarray]:
    """For each context, which windows start another time in any of the contexts."""
    data = np.frombuffer(SEPARATOR.join(contexts), np.uint8)
    neighbour, common = RunLengthIndex(data).matching_statistics(len(data))
    long = np.flatnonzero(common >= length)
    marked = np.zeros(len(data), bool)
    marked[long] = True
    marked[neighbour[long]] = True
    found, start = [], 0
    for c in contexts:
        found.append(marked[start : start + max(0, len(c) - length + 1)])
        start += len(c) + 1
    return found


def runs(flags: np.ndarray):
    """``(first, last)`` of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).view(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _index_blocks(batches):
    """Rows ``(hash, digest, times, context)`` come sorted by hash."""
    rows, held = [], 0

    def flush():
        marks = repeated_starts([r[3] for r in rows])
        out = []
        for (hashed, digest, times, context), flags in zip(rows, marks):
            if times > 1:
                out.append((hashed, digest, 0, len(context) - LENGTH))
            else:
                out += [(hashed, digest, a, b) for a, b in runs(flags)]
        columns = list(zip(*out)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["hash", "digest", "first", "last"]
        )

    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if held >= BLOCK_BYTES and row[0] != rows[-1][0]:
                yield flush()
                rows, held = [], 0
            rows.append(row)
            held += len(row[3]) + 1
    if rows:
        yield flush()


# --- texts ---------------------------------------------------------------------------


def _texts(salt):
    """Compressed texts with the number of their class; other columns pass."""

    def run(batches):
        for batch in batches:
            kept = [i for i, n in enumerate(batch.schema.names) if n != "text"]
            for part in text_slices(batch, "text", SLICE_BYTES):
                texts = [t.encode() for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i) for i in kept],
                        pa.array([_number(class_key(t, salt)) for t in texts], pa.int64()),
                        pa.array([pa.compress(t, "zstd", asbytes=True) for t in texts], pa.binary()),
                        pa.array(list(map(len, texts)), pa.int64()),
                    ],
                    names=[*[part.schema.names[i] for i in kept], "node", "packed", "n_bytes"],
                )

    return run


def _plain(packed, size) -> bytes:
    return pa.decompress(packed, size, "zstd", asbytes=True) if size else b""


def _cut_contexts(batches):
    for batch in batches:
        out = []
        for packed, size, found in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            text = _plain(packed, size)
            for a in found:
                low = a["place"] >> 32
                high = low + (a["place"] & 0xFFFF)
                out.append((a["hash"], a["digest"], a["times"], text[low : high + LENGTH]))
        columns = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array(c, pa.int64()) for c in columns[:3]],
                pa.array(columns[3], pa.binary()),
            ],
            names=["hash", "digest", "times", "context"],
        )


def _cut_windows(batches):
    """Digest of every window of hot anchors, with its place from the anchor."""
    for batch in batches:
        for packed, size, found in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            text = np.frombuffer(_plain(packed, size), np.uint8)
            digests = PrefixDigests(text)
            for a in found:
                low, count = a["place"] >> 32, (a["place"] & 0xFFFF) + 1
                starts = low + np.arange(count)
                windows = digests.of(starts, starts + LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, a["hash"])),
                        pa.array(np.full(count, a["digest"])),
                        pa.array(np.full(count, a["times"])),
                        pa.array(np.arange(count)),
                        pa.array(windows),
                    ],
                    names=["hash", "digest", "times", "first", "window"],
                )


def _union(starts, ends):
    """Maximal runs covered by half-open ranges."""
    merged = []
    for a, b in sorted(zip(starts, ends)):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def _remove(as_text: bool):
    """Spans and remaining bytes of each text; as text, without bytes of cut characters."""

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            at = {n: batch.column(i) for i, n in enumerate(names)}
            rest = [n for n in names if n not in ("packed", "n_bytes", "spans", "whole")]
            spans, kept = [], []
            rows = zip(*[at[n].to_pylist() for n in ("packed", "n_bytes", "spans", "whole")])
            for packed, size, found, whole in rows:
                text = _plain(packed, size)
                if whole and size >= LENGTH:
                    merged = [[0, size]]
                else:
                    merged = _union([s["from"] for s in found or []], [s["to"] for s in found or []])
                parts, end = [], 0
                for a, b in merged:
                    parts.append(text[end:a])
                    end = b
                parts.append(text[end:])
                spans.append([{"from": a, "to": b} for a, b in merged])
                rest_of = b"".join(parts)
                kept.append(rest_of.decode(errors="ignore") if as_text else rest_of)
            span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            left = pa.array(kept, pa.string() if as_text else pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[at[n] for n in rest], at["n_bytes"], pa.array(spans, span), left],
                names=[*rest, "n_bytes", "spans", "kept"],
            )

    return run


def _near(table: DataFrame, row_bytes: int) -> DataFrame:
    """The table, marked for broadcast if its counted rows are small."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


class RepeatedBytes:
    """One run over ``rows`` that have a column ``text``; all others pass through."""

    def __init__(self, rows: DataFrame, salt=0):
        self.rows, self.salt = rows, salt
        self.survey = written(
            rows.select("text").mapInArrow(_survey(salt), SURVEY_SCHEMA), "suffix-survey"
        )
        classes = self.survey.groupBy("key", "node").agg(F.count("*").alias("rows"))
        self.classes = written(classes, "suffix-classes")
        if not self.classes.groupBy("node").count().filter("count > 1").isEmpty():
            raise ValueError("two texts share a number: use another salt")

    def _packed_texts(self, rows: DataFrame) -> DataFrame:
        kept = [f for f in rows.schema.fields if f.name != "text"]
        made = StructType.fromDDL("node bigint, packed binary, n_bytes bigint")
        return rows.mapInArrow(_texts(self.salt), StructType([*kept, *made.fields]))

    def repeated_anchors(self) -> DataFrame:
        """``(hash, node, place, digest)`` of anchors that occur more than once."""
        posted = self.survey.select("node", F.arrays_zip("hash", "place", "digest").alias("a"))
        posted = posted.select("node", F.inline("a"))
        several = posted.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
        return written(posted.join(several, "hash").distinct(), "suffix-anchors")

    def _contexts_of(self, wanted: DataFrame, run, schema: str) -> DataFrame:
        """Cuts one context for each ``(hash, digest, times, node, place)``."""
        lists = written(
            wanted.groupBy("node").agg(
                F.collect_list(F.struct("hash", "digest", "times", "place")).alias("found")
            ),
            "suffix-wanted",
        )
        nodes = _near(lists.select("node"), 16)
        texts = (
            self._packed_texts(self.rows.select("text"))
            .join(nodes, "node", "semi")
            .dropDuplicates(["node"])
        )
        return (
            texts.join(lists, "node").select("packed", "n_bytes", "found").mapInArrow(run, schema)
        )

    def spans(self) -> DataFrame:
        """``(node, spans)``: ranges of bytes that repeat, not yet merged."""
        anchors_ = self.repeated_anchors()
        contexts = (
            anchors_.groupBy("hash", "digest")
            .agg(F.count("*").alias("times"), F.min("node").alias("node"))
        )
        contexts = written(contexts, "suffix-contexts")
        kinds = contexts.groupBy("hash").agg(
            F.count("*").alias("kinds"), F.max("times").alias("most")
        )
        kinds = written(kinds, "suffix-kinds")
        plain = anchors_.join(
            kinds.filter("kinds = 1 and most > 1").select("hash"), "hash"
        ).select("node", *self._range(F.lit(0), F.expr("place & 65535")))
        # One text stands for each context of the others.
        mixed = contexts.join(kinds.filter("kinds > 1"), "hash")
        places = anchors_.groupBy("hash", "digest", "node").agg(F.min("place").alias("place"))
        wanted = written(
            mixed.join(places, ["hash", "digest", "node"]).select(
                "hash", "digest", "times", "kinds", "node", "place"
            ),
            "suffix-mixed",
        )
        cut = self._contexts_of(
            wanted.filter(F.col("kinds") <= GROUP),
            _cut_contexts,
            "hash bigint, digest bigint, times bigint, context binary",
        )
        marked = cut.repartition("hash").sortWithinPartitions("hash").mapInArrow(
            _index_blocks, "hash bigint, digest bigint, first bigint, last bigint"
        )
        hot = wanted.filter(F.col("kinds") > GROUP)
        if not hot.isEmpty():
            marked = marked.unionByName(self._hot_windows(hot))
        marked = written(marked, "suffix-marks")
        indexed = anchors_.join(marked, ["hash", "digest"]).select(
            "node", *self._range(F.col("first"), F.col("last"))
        )
        own = self.survey.filter("size(own_from) > 0").select(
            "node", F.inline(F.arrays_zip("own_from", "own_to")).alias("from", "to")
        )
        every = plain.unionByName(indexed).unionByName(own).distinct()
        return every.groupBy("node").agg(F.collect_list(F.struct("from", "to")).alias("spans"))

    @staticmethod
    def _range(first, last):
        low = F.expr("shiftright(place, 32)")
        return (low + first).alias("from"), (low + last + LENGTH).alias("to")

    def _hot_windows(self, hot: DataFrame) -> DataFrame:
        windows = written(
            self._contexts_of(
                hot,
                _cut_windows,
                "hash bigint, digest bigint, times bigint, first bigint, window bigint",
            ),
            "suffix-windows",
        )
        several = (
            windows.groupBy("hash", "window").agg(F.sum("times").alias("n")).filter("n > 1")
        )
        return windows.join(several, ["hash", "window"]).select(
            "hash", "digest", "first", F.col("first").alias("last")
        )

    def removed(self, as_text=False) -> DataFrame:
        """All other columns of the rows, ``node``, ``n_bytes``, ``spans`` and ``kept``."""
        spans = self.spans()
        whole = self.classes.filter("rows > 1").select("node", F.lit(True).alias("whole"))
        found = written(spans.join(whole, "node", "full"), "suffix-spans")
        rows = self._packed_texts(self.rows).join(found, "node", "left")
        kept = [f for f in self.rows.schema.fields if f.name != "text"]
        order = ["node", *[f.name for f in kept], "packed", "n_bytes", "spans", "whole"]
        made = StructType.fromDDL(
            "node bigint, n_bytes bigint, spans array<struct<from:bigint,to:bigint>>, "
            + ("kept string" if as_text else "kept binary")
        ).fields
        schema = StructType([made[0], *kept, *made[1:]])
        return rows.select(*order).mapInArrow(_remove(as_text), schema)


def remove_repeats(docs: DataFrame, doc_id="doc_id", text="text", salt=0) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` for every row; ``kept`` are the remaining bytes."""
    found = RepeatedBytes(pick(docs, doc_id=doc_id, text=text), salt).removed()
    return found.select("doc_id", "n_bytes", "spans", "kept")


def documents_without_repeats(docs: DataFrame, text="text", size="n_chars", salt=0) -> DataFrame:
    """``docs`` with shortened texts, under the same columns.

    Bytes of characters that a removed range cuts are left out. A column ``size``, if
    there is one, gets the new number of characters; null texts stay null.
    """
    names = docs.columns
    plain = [f"_c{i}" for i in range(len(names))]
    at_text = plain[names.index(text)]
    # The text goes once through Python; whether it was null goes with the other columns.
    others = [c for c in plain if c != at_text]
    rows = docs.toDF(*plain).select(
        F.struct(*others, F.col(at_text).isNotNull().alias("there")).alias("row"),
        F.col(at_text).alias("text"),
    )
    # No Python step of its own for the characters: each step of a stage keeps a worker
    # beside the others, with its memory, for all later stages.
    short = RepeatedBytes(rows, salt).removed(as_text=True)
    columns = {c: F.col(f"row.{c}") for c in others}
    columns[at_text] = F.when(F.col("row.there"), F.col("kept"))
    if size in names:
        kind = docs.schema.fields[names.index(size)].dataType
        columns[plain[names.index(size)]] = F.length(columns[at_text]).cast(kind)
    return short.select(*[columns[c].alias(c) for c in plain]).toDF(*names)


def op8_query(spark, sf_dir) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["to"] - s["from"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ship(__name__)
