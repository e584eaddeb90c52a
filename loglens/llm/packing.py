"""Best-fit packing with certified partitions.

Documents become pieces of at most ``CAPACITY`` tokens. Partitions of a bounded
number of pieces are packed by best-fit decreasing; dual-feasible functions give
a lower bound on the bins that each partition needs. A partition whose count
meets its bound is certified and final. In the others, full bins stay, and the
pieces of all bins with gaps are dealt out again among fewer partitions and
packed anew, until all are certified, the bins with gaps meet the bound of all their
pieces, or one partition is left. A round that lowers no number of bins is dropped,
and the next one has half its partitions; so the rounds come to an end, and none
makes the packing worse. Pieces are rows of a few numbers; texts never move.

Defined results: a null text is empty and has the end token only; every row is
packed, also rows with equal or null ids; pieces of ``CAPACITY`` tokens fill a
sequence of their own. An empty table gives no pieces. Other columns do not
matter.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import pick, ship, text_slices, texts_of, worker_cache, written

CAPACITY = 1024
END_TOKEN = 2
# A text with a longer run of white space is encoded by the library itself.
LONG_SPACE = 100_000
_SPACES = re.compile(r"\s+")
# Pieces that one task packs.
PARTITION_PIECES = 50_000


def load_tokenizer(path: str):
    """Encoder of ordinary text for a byte-level vocabulary file, once per worker.

    The file's own merges are ranks in the order of their identifiers; the ranked
    encoder gives the same identifiers and is several times faster than the
    library that the file belongs to (tests compare both). Added tokens of the file
    have no rank, see :func:`load_encoder`.
    """
    cache = worker_cache()
    if ("bpe", path) not in cache:
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            tokenizer = json.load(file)
        model = tokenizer["model"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + i): b for i, b in enumerate(hidden)}
        added = {token["content"] for token in tokenizer["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in model["vocab"].items()
            if token not in added
        }
        cache["bpe", path] = tiktoken.Encoding(
            "own",
            pat_str=(
                r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            ),
            mergeable_ranks=ranks,
            special_tokens={},
        )
    return cache["bpe", path]


def load_encoder(path: str, encode_special_tokens: bool):
    """Identifiers of a text as the library gives them, as a function.

    The library finds added tokens of the file inside plain text, and encodes what
    stands between them; with ``encode_special_tokens`` (its name there) it reads
    their letters as text.
    """
    ranked = load_tokenizer(path).encode_ordinary
    cache = worker_cache()

    def plain(text):
        if len(text) <= LONG_SPACE or max(map(len, _SPACES.findall(text)), default=0) <= LONG_SPACE:
            return ranked(text)
        # The ranked encoder's splitting rule runs out of stack on very long white space.
        if ("library", path) not in cache:
            from tokenizers import Tokenizer

            cache["library", path] = Tokenizer.from_file(path)
            cache["library", path].encode_special_tokens = True
        return cache["library", path].encode(text, add_special_tokens=False).ids

    if ("added", path) not in cache:
        import json

        with open(path, encoding="utf-8") as file:
            tokens = json.load(file)["added_tokens"]
        # Other kinds take neighbouring characters with them.
        for token in tokens:
            if not token["special"] or any(
                token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")
            ):
                raise ValueError(f"added token {token['content']!r} is not found literally")
        cache["added", path] = {token["content"]: token["id"] for token in tokens}
    added = cache["added", path]
    if encode_special_tokens or not added:
        return plain
    # The longest of those that begin at one place.
    literals = sorted(added, key=len, reverse=True)
    parts_of = re.compile(f"({'|'.join(map(re.escape, literals))})").split

    def encode(text):
        parts = parts_of(text)
        ids = plain(parts[0])
        for token, after in zip(parts[1::2], parts[2::2]):
            ids.append(added[token])
            ids += plain(after)
        return ids

    return encode


def cut(n: int, capacity=CAPACITY):
    """``(start, length)`` of the pieces of ``n`` tokens; the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def _piece_batches(path, capacity, encode_special_tokens):
    def run(batches):
        encode = load_encoder(path, encode_special_tokens)
        for batch in batches:
            for part in text_slices(batch, "text"):
                at, number, start, length, crc = [], [], [], [], []
                for i, text in enumerate(texts_of(part, "text")):
                    ids = encode(text)
                    ids.append(END_TOKEN)
                    data = np.array(ids, "<u4").tobytes()
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        at.append(i)
                        number.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(data[4 * s : 4 * (s + n)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(at, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def lower_bound(counts: np.ndarray, capacity=CAPACITY) -> int:
    """Bins that ``counts[size]`` pieces need at least.

    The greatest of the volume bound and the bounds of two families of
    dual-feasible functions: one that rounds sizes above a threshold up and those
    below it away, and one that counts how many multiples of 1/(k+1) a size holds.
    """
    sizes = np.flatnonzero(counts)
    if not len(sizes):
        return 0
    n = counts[sizes].astype(np.int64)
    best = -(-int((sizes * n).sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        value = np.where(sizes > capacity - t, capacity, np.where(sizes < t, 0, sizes))
        best = max(best, -(-int((value * n).sum()) // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        # Exact multiples keep their size, others round to whole k-ths of the bin.
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * n).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity=CAPACITY):
    """``(bin, offset)`` of each piece, and the room left in each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    waiting = [[] for _ in range(capacity + 1)]
    present = 0  # bit r: a bin with room r waits
    room = []
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = present >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = waiting[r].pop()
            if not waiting[r]:
                present ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offset[i] = b, capacity - r
        left = r - size
        room[b] = left
        if left:
            waiting[left].append(b)
            present |= 1 << left
    return bins, offset, np.array(room, np.int64)


def _pack_group(capacity, last):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy().astype(np.int64)
        bins, offset, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        certified = last or len(room) <= bound
        final = np.full(len(lengths), True) if certified else room[bins] == 0
        return table.drop_columns(["part"]).append_column(
            "part", pa.array(np.full(len(lengths), key[0].as_py()), pa.int64())
        ).append_column("bin", pa.array(bins, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64())
        ).append_column("final", pa.array(final, pa.bool_()))

    return run


def pack_pieces(pieces: DataFrame, capacity=CAPACITY, partition_pieces=PARTITION_PIECES):
    """Adds ``sequence_id`` and ``offset`` to rows that have a column ``length``."""
    fields = [(f.name, f.dataType.simpleString()) for f in pieces.schema.fields]
    names = [name for name, _ in fields]
    schema = ", ".join(f"`{n}` {t}" for n, t in fields)
    schema += ", part bigint, bin bigint, offset bigint, final boolean"
    whole = pieces.filter(F.col("length") == capacity)
    done = whole.withColumns(
        {
            "offset": F.lit(0).cast("bigint"),
            "round": F.lit(0),
            "part": F.lit(0).cast("bigint"),
            "bin": F.monotonically_increasing_id(),
        }
    )
    rest = pieces.filter(F.col("length") < capacity)
    # The last packing of ``rest``: its table, its bins, and the pieces of a partition.
    kept, bins, size = None, None, partition_pieces
    turn = first = 0
    while True:
        sizes = rest.groupBy("length").agg(F.count("*").alias("n")).collect()
        left = sum(r["n"] for r in sizes)
        if not left:
            break
        counts = np.zeros(capacity + 1, np.int64)
        for r in sizes:
            counts[r["length"]] = r["n"]
        parts = -(-left // size)
        if kept is not None and bins <= lower_bound(counts, capacity):
            done = done.unionByName(kept)
            break
        turn += 1
        # Partitions have numbers of their own in every round.
        dealt = rest.withColumn(
            "part",
            (F.pmod(F.xxhash64(F.lit(turn), *names), F.lit(parts)) + first).cast("bigint"),
        )
        first += parts
        packed = written(
            dealt.groupBy("part").applyInArrow(_pack_group(capacity, parts == 1), schema),
            "packed",
        )
        # Every bin has one piece at its start.
        begun = packed.filter("offset = 0").agg(
            F.count("*").alias("bins"), F.count_if(~F.col("final")).alias("open")
        )
        made = begun.first()
        if kept is not None and made["bins"] >= bins:
            # Nothing gained: the packing before holds until fewer partitions lower it.
            if parts == 1:
                done = done.unionByName(kept)
                break
            size = -(-left // (parts // 2))
            continue
        packed = packed.withColumn("round", F.lit(turn))
        done = done.unionByName(packed.filter("final").drop("final"))
        kept, bins = packed.filter("not final").drop("final"), made["open"]
        rest = kept.select(*names)
    # Lowest bit: packed by rounds; above it the partition and 24 bits for the bin
    # in it, or the row number of a whole piece.
    place = F.when(F.col("round") == 0, F.col("bin")).otherwise(
        F.shiftleft("part", 24) + F.col("bin")
    )
    rounds = (F.col("round") > 0).cast("bigint")
    return done.withColumn("sequence_id", F.shiftleft(place, 1) + rounds).select(
        *names, "sequence_id", "offset"
    )


def document_pieces(
    docs: DataFrame, tokenizer_path: str, doc_id="doc_id", text="text", encode_special_tokens=True
):
    """``(doc_id, piece, start, length, ids_crc32)``."""
    rows = pick(docs, doc_id=doc_id, text=text)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _piece_batches(tokenizer_path, CAPACITY, encode_special_tokens),
        f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint",
    )


def packed_documents(
    docs: DataFrame, tokenizer_path: str, doc_id="doc_id", text="text", encode_special_tokens=True
):
    """Pieces with ``sequence_id`` and ``offset``.

    The registered queries pass ``encode_special_tokens=False``, as the library has it
    unless told otherwise.
    """
    pieces = document_pieces(docs, tokenizer_path, doc_id, text, encode_special_tokens)
    return pack_pieces(written(pieces, "pieces"))


def op5_query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packed_documents(docs, path, encode_special_tokens=False)


ship(__name__)
