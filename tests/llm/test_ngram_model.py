"""The Elias-Fano trie and the language model against plain versions."""

import mmap
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loglens.llm import ngram_model
from loglens.llm.elias_fano import Monotone, Trie

SCHEMA = "doc_id bigint, text string, TEXT string, row bigint, block bigint, held boolean"


def _sequence(values):
    header, low, high = Monotone.arrays(values)
    return Monotone(int(header[0]), int(header[1]), low, high)


@pytest.mark.parametrize("most", [1, 3, 60, 1000, 10**12])
def test_monotone_sequence(most):
    draw = np.random.default_rng(most)
    for n in (1, 2, 63, 64, 65, 300):
        values = np.sort(draw.integers(0, most, n))
        coded = _sequence(values)
        assert (coded[np.arange(n)] == values).all()
        x = np.append(values, draw.integers(0, 2 * most + 3, 200))
        first = draw.integers(0, n, len(x))
        end = first + draw.integers(0, n + 1 - first)
        place, equal = coded.successor(x, first, end)
        plain = [next((i for i in range(a, b) if values[i] >= v), b) for v, a, b in zip(x, first, end)]
        assert (place == plain).all()
        assert (equal == [p < b and values[p] == v for p, v, b in zip(plain, x, end)]).all()


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("words", [2, 9, 5_000_000])
def test_trie(order, words, tmp_path):
    draw = np.random.default_rng(words + order)
    for n in (0, 1, 5, 700):
        grams = np.unique(draw.integers(0, words, (n, order)), axis=0)
        codes = draw.integers(1, 256, len(grams)).astype(np.uint8)
        parts = Trie.parts(grams, codes)
        path = tmp_path / f"{n}"
        path.write_bytes(bytes(Trie.size(parts)))
        with open(path, "r+b") as file:
            Trie.write(parts, mmap.mmap(file.fileno(), 0))
        with open(path, "rb") as file:
            trie = Trie.mapped(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        assert (trie.find(grams) == codes).all()
        known = {tuple(g): c for g, c in zip(grams.tolist(), codes.tolist())}
        asked = np.unique(draw.integers(0, words + 2, (400, order)), axis=0)
        assert trie.find(asked).tolist() == [known.get(tuple(g), 0) for g in asked.tolist()]


def _words(text):
    lower = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    return [*re.findall(rb"[^\x20\x09-\x0D]+", lower), b"</s>"]


def _scores(rows, order):
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    grams = Counter()
    n_docs = held.count(False)
    padded = [[b"<s>"] * (order - 1) + _words(t) for _, t in rows]
    for words, out in zip(padded, held):
        if not out:
            for i in range(order - 1, len(words)):
                for n in range(1, order + 1):
                    grams[tuple(words[i - n + 1 : i + 1])] += 1
    count = {g[0]: c for g, c in grams.items() if len(g) == 1}
    tokens = sum(count.values())
    corpus = ngram_model.Corpus(tokens, len(count), 1, order)

    def total(context):
        if set(context) == {b"<s>"}:
            return n_docs
        if len(context) == 1:
            return count.get(context[0], 0)
        return float(share(context)) * 10**corpus.step * (total(context[:-1]) + ngram_model.MASS)

    def share(gram):
        if not grams[gram]:
            return 0.0
        given = grams[gram] / (total(gram[:-1]) + ngram_model.MASS)
        return float(corpus.share_of(corpus.code_of(np.array([given])))[0])

    def chance(gram):
        if len(gram) == 1:
            return (count.get(gram[0], 0) + 0.1) / (tokens + 0.1 * (len(count) + 1))
        mass = ngram_model.MASS
        return share(gram) + mass / (total(gram[:-1]) + mass) * chance(gram[1:])

    for context in list({g[:-1] for g in grams if len(g) == order})[:20]:
        assert sum(chance((*context, w)) for w in [*count, b"\n"]) <= 1 + 1e-9
    for (doc, _), words, out in zip(rows, padded, held):
        places = range(order - 1, len(words))
        yield (
            doc,
            out,
            len(places),
            sum(words[i] in count for i in places),
            tokens,
            sum(np.log10(chance((words[i],))) for i in places),
            sum(np.log10(chance(tuple(words[i - order + 1 : i + 1]))) for i in places),
        )


def _same(found, expected):
    def key(row):
        return repr(tuple(round(v, 5) if isinstance(v, float) else v for v in row))

    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:], b[5:], rtol=1e-9, atol=1e-9)


def _texts():
    draw = random.Random(3)
    names = ["A", "a", "bb", "ccc", "é", "É", " x", "long" * 30, *[f"w{i}" for i in range(40)]]
    rows = [(i, draw.choice([" ", "\n", "\t "]).join(draw.choices(names, k=draw.randrange(30)))) for i in range(80)]
    rows += [(None, "null id"), (None, None), (3, ""), (3, "again again"), (4, " \x0b\x0c\r ")]
    rows += [(200, " ".join(draw.choices(names, k=3000))), (10, "never seen words here")]
    return rows + [(300 + i, "the same text a few times over") for i in range(30)]


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("small", [False, True])
def test_scores(spark, monkeypatch, order, small):
    if small:
        # Blocks of a few texts, long texts in pieces, many shards, split contexts.
        monkeypatch.setattr(ngram_model, "BLOCK_BYTES", 700)
        monkeypatch.setattr(ngram_model, "SHARD_GRAMS", 20)
    rows = _texts()
    spark.conf.set("spark.sql.caseSensitive", "true")
    table = spark.createDataFrame([(d, t, "x", 1, 2, True) for d, t in rows], SCHEMA)
    found = ngram_model.score_documents(table.repartition(3), order=order).collect()
    spark.conf.set("spark.sql.caseSensitive", "false")
    _same(found, _scores(rows, order))


def test_scores_without_training_texts(spark):
    table = spark.createDataFrame([(10, "a b"), (20, None)], "doc_id bigint, text string")
    found = ngram_model.score_documents(table, folds=1).collect()
    assert len(found) == 2
    assert all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 for r in found)
    assert ngram_model.score_documents(table.limit(0)).count() == 0


def test_held_out_texts_are_likelier_than_by_counts(spark):
    found = ngram_model.op11_query(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r["score"] for r in found) > 0.9 * sum(r["base_score"] for r in found)
