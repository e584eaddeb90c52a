"""SentencePiece encoding and decoding by a distinct-chunk table.

No piece of the vocabulary holds a whitespace marker after another character
(checked when the model is loaded), so no merge crosses the start of a run of
markers: a text is a sequence of marked words (a run of markers and what follows
up to the next run), and each can be segmented alone. A task segments every
distinct marked word of its block once, into a table of identifiers and decoded
text, and joins both back by position. The table is bounded by ``TABLE_WORDS``;
a full table is dropped and built anew, which changes no result.

Defined results: a null or empty text gives no identifiers and an empty decoded
text; characters outside the vocabulary become byte pieces; the marker character
itself is read as a space, as the library does. Rows stay one to one, whatever
repeats; other columns do not matter.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import pick, ship, text_slices, texts_of, worker_cache

MARK = "▁"
TABLE_WORDS = 1_000_000
# A word longer than this is segmented where it stands and not kept.
KEPT_CHARS = 64
_WORDS = re.compile(" +[^ ]*")


def load_model(path: str):
    """The model, once per Python worker, after checking that words stand alone."""
    cache = worker_cache()
    if ("sp", path) not in cache:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(model.get_piece_size()):
            if not model.is_control(i) and MARK in model.id_to_piece(i).lstrip(MARK):
                raise ValueError("a piece crosses a whitespace marker")
        cache["sp", path] = model
    return cache["sp", path]


class WordTable:
    """Marked word to ``(identifiers, decoded text)``."""

    def __init__(self, model):
        self.model = model
        self.known = {}
        self.anchor = model.encode("a")
        self.anchor_text = model.decode(self.anchor)

    def _segment(self, words):
        # The library puts one marker before a text; it is the first of the word.
        ids = self.model.encode([w[1:] for w in words], num_threads=1)
        # An empty text has no identifiers, so a lone marker is asked for by its piece.
        lone = [self.model.piece_to_id(MARK)]
        ids = [lone if w == " " else i for w, i in zip(words, ids)]
        cut = len(self.anchor_text)
        texts = self.model.decode([self.anchor + i for i in ids], num_threads=1)
        return [(i, t[cut:]) for i, t in zip(ids, texts)]

    def learn(self, words):
        """Segments the words that are not known; returns those too long to keep."""
        words = dict.fromkeys(words)
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > TABLE_WORDS:
            self.known.clear()
            new = list(words)
        found = dict(zip(new, self._segment(new)))
        self.known.update(found)
        long = [w for w in new if len(w) > KEPT_CHARS]
        return long

    def forget(self, words):
        for w in words:
            self.known.pop(w, None)


def marked_words(text: str) -> list[str]:
    return _WORDS.findall(" " + text.replace(MARK, " ")) if text else []


def encode_batch(table: WordTable, texts):
    """``(ids, decoded)`` of every text."""
    words = [marked_words(t) for t in texts]
    long = table.learn(chain.from_iterable(words))
    get = table.known.__getitem__
    made = []
    for row in words:
        parts = list(map(get, row))
        ids = np.fromiter(chain.from_iterable([p[0] for p in parts]), np.int32)
        decoded = "".join([p[1] for p in parts])
        made.append((ids, decoded[1:] if decoded.startswith(" ") else decoded))
    table.forget(long)
    return made


def _encoder(path):
    def run(batches):
        table = WordTable(load_model(path))
        for batch in batches:
            for part in text_slices(batch, "text"):
                made = encode_batch(table, texts_of(part, "text"))
                ends = np.cumsum([0, *[len(ids) for ids, _ in made]], dtype=np.int32)
                flat = np.concatenate([ids for ids, _ in made])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                        pa.array([d for _, d in made], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return run


def encode_documents(docs: DataFrame, model_path: str, doc_id="doc_id", text="text") -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` for every row."""
    rows = pick(docs, doc_id=doc_id, text=text)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _encoder(model_path), f"doc_id {id_type}, ids array<int>, decoded string"
    )


def op1_query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    coded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


ship(__name__)
