"""Language-model scores from an n-gram trie with Elias-Fano levels.

Texts are read once, into blocks of a bounded number of bytes: the different words of a
block, its documents as numbers of these words, and how often training documents use
each word. Counts are summed over all blocks, known words get numbers, and each block
learns the numbers and counts of its own words. For every order, blocks send their
different n-grams (numbers, training counts, and the count of the context) to shards by
context; a shard sums them, builds a trie of those that training documents hold and answers
every block with the codes that its n-grams have there. Blocks add up their documents.

The model is interpolated with ``MASS`` imagined words in each context c,
``p(w | c) = (count(c w) + MASS * p(w | shorter c)) / (count(c) + MASS)``, and starts from
``(count(w) + 0.1) / (N + 0.1 * (V + 1))``. The first term is what a trie stores, in 255
steps of equal ratio, rounded down, so that no context gives away more than it has.

Contexts that are more common than a shard is large are split by the next word, which
needs no total of a shard: counts of contexts come from the order below. An n-gram comes
from a block once, whatever its count, and a shard's n-grams follow from the number of
tokens. Words are compared as bytes; nothing depends on the size of a table but the
number of shards.

Defined results: a null or empty text has its end only; texts are read as UTF-8, A-Z as
lower case; a null id is never held out; rows with one id are scored each. An empty table
gives no rows; without any training text all words are unknown. A text longer than a block
is cut between words, with the context carried over. Other columns do not matter.
"""

from __future__ import annotations

import math
import mmap
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.llm.common import pick, ship, text_slices, written
from loglens.llm.elias_fano import Trie
from loglens.llm.labelled import held_out

ORDER = 2
MASS = 300.0
# Bytes of text in a block, and of one piece of a longer text.
BLOCK_BYTES = 8 * 1024 * 1024
# N-grams of a shard, on average.
SHARD_GRAMS = 1 << 20
FOLDS, HELD_FOLD = 10, 0
BEGIN, END = b"", b"\n"
# Numbers of words: 0 is unknown, 1 the begin, others are known words.
BEGIN_ID, FIRST_ID = 1, 2
# Bits of a word's number in a block; three words fit into a key.
LOCAL_BITS = 21
_WHITE = re.compile(rb"[ \t-\r]")


def pieces(text: str, limit: int):
    """``(words, ends)``: the lower-case words of ``text``, cut between words at ``limit``."""
    data = text.encode().lower()
    start = 0
    while len(data) - start > limit:
        cut = _WHITE.search(data, start + limit)
        if cut is None:
            break
        yield data[start : cut.start()].split(), False
        start = cut.start()
    yield (data[start:] if start else data).split(), True


class BlockWriter:
    """Collects documents until a block is full."""

    def __init__(self, order, id_type):
        self.carry, self.id_type = order - 1, id_type
        self.clear()

    def clear(self):
        self.known = {BEGIN: 0, END: 1}
        self.bytes, self.rows, self.ids, self.held, self.parts = 0, [], [], [], []

    def add(self, row, doc_id, held, before, words, size):
        known = self.known
        put = known.setdefault
        tokens = [put(w, len(known)) for w in before]
        tokens += [put(w, len(known)) for w in words]
        self.parts.append(np.array(tokens, np.int32))
        self.rows.append(row)
        self.ids.append(doc_id)
        self.held.append(held)
        self.bytes += size

    def finish(self, number):
        lengths = np.array([len(p) for p in self.parts], np.int64)
        tokens = np.concatenate(self.parts)
        counted = ~np.repeat(np.array(self.held, bool), lengths)
        begin = np.cumsum(lengths) - lengths
        for k in range(self.carry):
            counted[begin + k] = False
        counts = np.bincount(tokens[counted], minlength=len(self.known))
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.rows], pa.list_(pa.int64())),
                pa.array([self.ids], pa.list_(self.id_type)),
                pa.array([self.held], pa.list_(pa.bool_())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([_squeezed(tokens)], pa.binary()),
                pa.array([len(self.known)], pa.int32()),
                pa.array([list(self.known)], pa.list_(pa.binary())),
                pa.array([counts], pa.list_(pa.int64())),
            ],
            names=["block", "rows", "ids", "held", "lengths", "tokens", "n_words", "words", "counts"],
        )
        self.clear()
        return batch


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed numbers: their lowest bytes first, then the next ones, and so on."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return pa.compress(flat.T.tobytes(), codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(data, n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).reshape(-1).view(kind)


def _packed(columns) -> bytes:
    """Number columns of one length as one value."""
    coded = [_squeezed(c) for c in columns]
    sizes = [len(columns[0]), *map(len, coded)]
    return b"".join([n.to_bytes(8, "little") for n in sizes] + coded)


def _opened(data: bytes, kinds) -> list[np.ndarray]:
    at = 8 * (len(kinds) + 1)
    n, *sizes = np.frombuffer(data[:at], np.int64).tolist()
    columns = []
    for kind, size in zip(kinds, sizes):
        columns.append(_unsqueezed(data[at : at + size], kind, n))
        at += size
    return columns


def _block_batches(order):
    def run(batches):
        part = TaskContext.get().partitionId()
        row = number = part << 33
        block = None
        for batch in batches:
            for piece in text_slices(batch, "text"):
                block = block or BlockWriter(order, piece.column("doc_id").type)
                ids, held = (piece.column(c).to_pylist() for c in ("doc_id", "held"))
                for doc_id, out, text in zip(ids, held, piece.column("text").to_pylist()):
                    before = [BEGIN] * block.carry
                    for words, last in pieces(text or "", BLOCK_BYTES):
                        if last:
                            words.append(END)
                        size = sum(map(len, words)) + len(words)
                        if block.rows and block.bytes + size > BLOCK_BYTES:
                            yield block.finish(number)
                            number += 1
                        block.add(row, doc_id, out, before, words, size)
                        before = (before + words)[len(before) + len(words) - block.carry :]
                    row += 1
        if block and block.rows:
            yield block.finish(number)

    return run


def _mixed(values: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    values = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


class Corpus:
    """What blocks and shards have to know of all texts: a few numbers."""

    def __init__(self, tokens, words, all_tokens, order):
        self.tokens, self.words, self.order = tokens, words, order
        self.shards = max(1, -(-all_tokens // SHARD_GRAMS))
        # 255 steps from 1 down to the least share that a context can give.
        self.step = math.log10(tokens + MASS + 1) / 254

    def code_of(self, share):
        """Shares in steps, rounded down; 255 is 1."""
        lost = np.ceil(-np.log10(np.minimum(share, 1.0)) / self.step - 1e-9)
        return np.clip(255 - lost, 1, 255).astype(np.uint8)

    def share_of(self, code):
        code = code.astype(np.float64)
        return np.where(code > 0, 10.0 ** ((code - 255) * self.step), 0.0)


class Block:
    """The documents of a block as numbers of known words."""

    def __init__(self, row, known, corpus: Corpus):
        self.corpus, self.carry = corpus, corpus.order - 1
        self.block, self.rows, self.ids, self.held = (row[c] for c in ("block", "rows", "ids", "held"))
        self.lengths = np.array(row["lengths"], np.int64)
        local = _unsqueezed(row["tokens"], np.int32, int(self.lengths.sum()))
        numbers, counts = np.zeros(row["n_words"], np.int64), np.zeros(row["n_words"], np.int64)
        for data in known.values():
            nth, number, c = _opened(data, 3 * [np.int64])
            numbers[nth], counts[nth] = number, c
        numbers[0], docs = BEGIN_ID, counts[1]
        # Ranks follow the numbers, so that keys of ranks are in the order of numbers.
        order = np.argsort(numbers, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        if len(order) >> LOCAL_BITS:
            raise ValueError("a block holds too many words: lower BLOCK_BYTES")
        self.numbers = numbers[order]
        self.ranks, self.count = rank[local], counts[local]
        self.known = self.numbers[self.ranks] > 0
        self.begins = self.numbers[self.ranks] == BEGIN_ID
        begin = np.cumsum(self.lengths) - self.lengths
        self.starts = begin
        self.place = np.arange(len(local)) - np.repeat(begin, self.lengths)
        self.scored = self.place >= self.carry
        self.train = self.scored & ~np.repeat(np.array(self.held, bool), self.lengths)
        # How often the last word was a context; each training document has one begin.
        self.total = np.where(self.begins, docs, self.count).astype(np.float64)
        self.docs = docs
        self.log_base = (self.count + 0.1) / (corpus.tokens + 0.1 * (corpus.words + 1))
        self.chance = self.log_base

    def grams(self, n):
        """``(places, keys, first place of each, which of them each place has)``."""
        usable = self.place >= n - 1
        for k in range(n):
            usable[k:] &= self.known[: len(usable) - k or None]
        places = np.flatnonzero(usable)
        key = np.zeros(len(places), np.int64)
        for k in range(n - 1, -1, -1):
            key = key << LOCAL_BITS | self.ranks[places - k]
        keys, first, which = np.unique(key, return_index=True, return_inverse=True)
        return places, keys, places[first], which

    def shard_rows(self, n):
        """``(shard, block, n-grams, data)`` for all n-grams of the block."""
        places, keys, first, which = self.grams(n)
        columns = [
            self.numbers[(keys >> (LOCAL_BITS * k)) & ((1 << LOCAL_BITS) - 1)]
            for k in range(n - 1, -1, -1)
        ]
        counts = np.bincount(which, self.train[places], len(keys)).astype(np.int64)
        totals = self.total[first - 1]
        shard = self.shards(columns, totals)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for at, end in zip(cuts, np.append(cuts[1:], len(order))):
            chosen = order[at:end]
            words = [np.diff(c[chosen], prepend=0) for c in columns]
            data = _packed([*words, counts[chosen], totals[chosen]])
            yield int(shard[chosen[0]]), self.block, len(chosen), data

    def shards(self, columns, totals):
        """By context; contexts more common than a shard is large also by the next word."""
        mixed = np.zeros(len(totals), np.uint64)
        for c in columns[:-1]:
            mixed = _mixed(mixed + c.astype(np.uint64))
        spread = np.ceil(np.maximum(totals, 1) / SHARD_GRAMS).astype(np.int64)
        mixed = _mixed(mixed + (columns[-1] % spread).astype(np.uint64))
        return (mixed % np.uint64(self.corpus.shards)).astype(np.int64)

    def apply(self, n, answers):
        """Takes the codes of all n-grams: ``{shard: codes}`` in the order sent."""
        places, keys, first, which = self.grams(n)
        columns = [
            self.numbers[(keys >> (LOCAL_BITS * k)) & ((1 << LOCAL_BITS) - 1)]
            for k in range(n - 1, -1, -1)
        ]
        shard = self.shards(columns, self.total[first - 1])
        order = np.argsort(shard, kind="stable")
        codes = np.empty(len(keys), np.uint8)
        codes[order] = np.concatenate([answers[s] for s in sorted(answers)] or [codes[:0]])
        share = np.zeros(len(self.ranks))
        share[places] = self.corpus.share_of(codes[which])
        before = np.zeros(len(self.ranks))
        before[1:] = np.where(self.place[1:] >= n - 1, self.total[:-1], 0)
        self.chance = share + MASS / (before + MASS) * self.chance
        # The count of the n words as a context, not less than it was.
        upper = np.where(share > 0, share * 10**self.corpus.step * (before + MASS), 0)
        self.total = np.where(self.begins, float(self.docs), upper)

    def scores(self):
        def summed(values):
            return np.add.reduceat(np.where(self.scored, values, 0), self.starts)

        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.rows, pa.int64()),
                self.ids,
                pa.array(self.held, pa.bool_()),
                pa.array(summed(np.ones(len(self.ranks), np.int64))),
                pa.array(summed((self.count > 0).astype(np.int64))),
                pa.array(summed(np.log10(self.log_base))),
                pa.array(summed(np.log10(self.chance))),
            ],
            names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


_VALUES = ("block", "rows", "held", "lengths", "tokens", "n_words")


def _blocks(batches):
    """``(values, answers)`` of every block; answers as ``{order: {shard: data}}``.

    Rows of a block are together, the block's own row first.
    """
    current, answers = None, {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            if row["n"].as_py():
                given = answers.setdefault(row["n"].as_py(), {})
                given[row["shard"].as_py()] = row["codes"].as_py()
                continue
            if current:
                yield current, answers
            current = {n: row[n].as_py() for n in _VALUES}
            current["ids"], answers = row["ids"].values, {}
    if current:
        yield current, answers


def _loaded(values, answers, corpus, orders):
    block = Block(values, answers.get(1, {}), corpus)
    for n in orders:
        codes = {s: np.frombuffer(data, np.uint8) for s, data in answers.get(n, {}).items()}
        block.apply(n, codes)
    return block


_GRAMS = "shard bigint, block bigint, grams bigint, data binary"
_ANSWERS = "block bigint, n int, shard bigint, codes binary"


def _gram_batches(corpus, n):
    def run(batches):
        for values, answers in _blocks(batches):
            block = _loaded(values, answers, corpus, range(2, n))
            columns = list(zip(*block.shard_rows(n))) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["shard", "block", "grams", "data"],
            )

    return run


def shard_trie(grams, counts, totals, corpus: Corpus) -> Trie:
    """The trie of the n-grams (rows in order) that training documents hold, mapped."""
    held = counts > 0
    parts = Trie.parts(grams[held], corpus.code_of(counts[held] / (totals[held] + MASS)))
    memory = mmap.mmap(-1, Trie.size(parts))
    Trie.write(parts, memory)
    return Trie.mapped(memory)


def _answer(shard, rows, corpus, n):
    """Codes for the n-grams of each block in ``rows(block, grams, data)``."""
    columns = [[] for _ in range(n + 2)]
    for _, _, data in rows:
        opened = _opened(data, [np.int64] * (n + 1) + [np.float64])
        for k, values in enumerate(opened):
            columns[k].append(np.cumsum(values) if k < n else values)
    *words, counts, totals = [np.concatenate(c) for c in columns]
    order = np.lexsort(words[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for w in words:
        new[1:] |= w[order][1:] != w[order][:-1]
    begin = np.flatnonzero(new)
    grams = np.stack([w[order[begin]] for w in words], axis=1)
    sums = np.add.reduceat(counts[order], begin)
    trie = shard_trie(grams, sums, totals[order[begin]], corpus)
    codes = np.empty(len(order), np.uint8)
    codes[order] = trie.find(grams)[np.cumsum(new) - 1]
    at = 0
    for block, size, _ in rows:
        yield block, n, shard, codes[at : at + size].tobytes()
        at += size


def _answer_batches(corpus, n):
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())

    def answered(shard, rows):
        columns = zip(*_answer(shard, rows, corpus, n))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["block", "n", "shard", "codes"],
        )

    def run(batches):
        shard, held = None, []
        for batch in batches:
            for i, s in enumerate(batch.column("shard").to_pylist()):
                if s != shard and held:
                    yield answered(shard, held)
                    held = []
                shard = s
                held.append(tuple(batch.column(c)[i].as_py() for c in ("block", "grams", "data")))
        if held:
            yield answered(shard, held)

    return run


def _score_batches(corpus):
    def run(batches):
        for values, answers in _blocks(batches):
            yield _loaded(values, answers, corpus, range(2, corpus.order + 1)).scores()

    return run


def _packed_words(batches):
    """Numbers and counts of the words of each block, many rows in one value."""
    part = TaskContext.get().partitionId() << 33
    names, held, rows = ("block", "nth", "number", "c", "new"), [], 0

    def packed():
        nonlocal held, rows, part
        block, nth, number, c, new = (np.concatenate(columns) for columns in zip(*held))
        held, rows = [], 0
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order], prepend=-1))
        chosen = [order[a:b] for a, b in zip(cuts, np.append(cuts[1:], len(order)))]
        part += 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block[rows[0]] for rows in chosen], pa.int64()),
                pa.array([1] * len(chosen), pa.int32()),
                pa.array([part] * len(chosen), pa.int64()),
                pa.array([_packed([v[rows] for v in (nth, number, c)]) for rows in chosen]),
                pa.array([int(new[rows].sum()) for rows in chosen], pa.int64()),
            ],
            names=["block", "n", "shard", "codes", "new_words"],
        )

    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
        rows += batch.num_rows
        if rows > SHARD_GRAMS:
            yield packed()
    if rows:
        yield packed()


def _numbered_words(said: DataFrame) -> DataFrame:
    """``(block, n, shard, codes, new_words)``: the known words of each block, packed.

    A word is in a block once, so that the rows of a word are at most the blocks. Its number
    follows from the place of its first row in its partition, and numbers of different
    partitions alternate, so that they stay small. ``new_words`` counts each word once.
    """
    parts = int(said.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    word = Window.partitionBy("word")
    at = F.col("at").bitwiseAND((1 << 33) - 1) * parts + F.spark_partition_id() + FIRST_ID
    ordered = (
        said.repartition(parts, "word")
        .sortWithinPartitions("word")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("at", at)
    )
    known = ordered.withColumns({"c": F.sum("n").over(word), "number": F.min("at").over(word)})
    new = (F.col("at") == F.col("number")).alias("new")
    return (
        known.filter("c > 0")
        .select("block", "nth", "number", "c", new)
        .mapInArrow(_packed_words, f"{_ANSWERS}, new_words bigint")
    )


_SUM = "aggregate({}, 0L, (a, b) -> a + b)"


def score_documents(
    docs: DataFrame, doc_id="doc_id", text="text", order=ORDER, folds=FOLDS, fold=HELD_FOLD
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Rows whose checksum of the id leaves ``fold`` are held out; the others train. ``order``
    is 2 or 3.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    rows = pick(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("held", held_out(F.col("doc_id"), folds, fold))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    documents = (
        f"block bigint, rows array<bigint>, ids array<{id_type}>, held array<boolean>, "
        "lengths array<bigint>, tokens binary, n_words int"
    )
    blocks = written(
        rows.mapInArrow(
            _block_batches(order), f"{documents}, words array<binary>, counts array<bigint>"
        ),
        "lm-blocks",
    )
    said = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("nth", "w"))
    said = said.select("block", "nth", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    answers = written(_numbered_words(said), "lm-numbers")
    sizes = [F.expr(_SUM.format(c)) for c in ("counts", "lengths")]
    trained, all_tokens = blocks.agg(*[F.coalesce(F.sum(s), F.lit(0)) for s in sizes]).first()
    new_words = answers.agg(F.coalesce(F.sum("new_words"), F.lit(0))).first()[0]
    corpus = Corpus(trained, new_words, all_tokens, order)
    answers = answers.drop("new_words")
    numbered = blocks.drop("words", "counts")
    for n in range(2, order + 1):
        sent = _with_answers(numbered, answers).mapInArrow(_gram_batches(corpus, n), _GRAMS)
        shards = sent.repartition("shard").sortWithinPartitions("shard", "block")
        more = written(shards.mapInArrow(_answer_batches(corpus, n), _ANSWERS), "lm-answers")
        answers = answers.unionByName(more)
    scores = _with_answers(numbered, answers).mapInArrow(
        _score_batches(corpus),
        f"row bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double",
    )
    # Texts longer than a block are several rows up to here.
    return (
        scores.groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("held_out").alias("held_out"),
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(corpus.tokens).cast("bigint").alias("train_tokens"),
            "base_score",
            "score",
        )
    )


def _with_answers(numbered: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks, each followed by what shards have sent to it."""
    both = numbered.withColumn("n", F.lit(0)).unionByName(answers, allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "n", "shard")


def op11_query(spark, sf_dir) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ship(__name__)
