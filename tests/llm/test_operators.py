"""Corpus operators against plain versions: nulls, empty and long texts, ties, copies."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus_pipeline import packing_stage
from loglens.llm import (
    exact_dedup,
    near_vectors,
    packing,
    quality,
    sentencepieces,
    sharding,
    shingle_join,
    suffix_dedup,
    toxicity,
    url_filter,
)
from loglens.llm.common import components

from brute import jaccard, repeats, sha, shingles

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, TEXT string, score double, node bigint, n_chars bigint"


def _words(seed, n):
    draw = random.Random(seed)
    return [
        "".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n)
    ]


def _edited(words, seed, n):
    words, draw = list(words), random.Random(seed)
    for _ in range(n):
        words[draw.randrange(len(words))] = "edit" + str(draw.random())[2:6]
    return words


BASE = _words(1, 120)
LONG = " ".join(_words(2, 9_000))
PASSAGE = " ".join(_words(3, 60))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a b c"),
    (5, "A b  C"),
    (5, "A b  C"),
    (None, "seven words and a few more here"),
    (None, "seven words and a few more here"),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "x" * 900),
    (10, "ab" * 500 + " end"),
    (11, "tabs\tand▁marks  two   spaces \u00e9\u4e2d\U0001f600 <|endoftext|> </s>"),
    (12, PASSAGE),
    (13, "start " + PASSAGE + " end"),
    (14, " ".join(_words(4, 50)) + " " + PASSAGE[:260] + " other " + " ".join(_words(5, 50))),
    (15, " ".join(BASE)),
    *[(16 + i, " ".join(_edited(BASE, i, i % 6))) for i in range(40)],
    (100, "\u00e9" * 150 + "\u00e8" * 150),
    (101, "\u00e9" * 150 + "\u00e8" * 150 + "!"),
]


def _table(spark, rows):
    return spark.createDataFrame(
        [(i, t, "other", 0.5, 3, len(t or "")) for i, t in rows], SCHEMA
    ).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    table = _table(spark, ROWS).cache()
    table.count()
    spark.conf.set("spark.sql.caseSensitive", "false")
    return table


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_sentencepieces_as_the_library(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = []
    for doc, text in ROWS:
        ids = model.encode(text or "")
        expected.append((doc, ids, model.decode(ids)))
    found = sentencepieces.encode_documents(docs, path).collect()
    assert _sorted(found) == _sorted(expected)
    assert sentencepieces.encode_documents(docs.limit(0), path).count() == 0


def test_word_table_that_overflows(monkeypatch):
    monkeypatch.setattr(sentencepieces, "TABLE_WORDS", 5)
    model = sentencepieces.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    table = sentencepieces.WordTable(model)
    for text in ("one two three", "four five six", "one " * 3):
        ids, decoded = sentencepieces.encode_batch(table, [text])[0]
        assert ids.tolist() == model.encode(text)
        assert decoded == model.decode(ids.tolist())


def test_exact_groups(docs):
    groups = defaultdict(list)
    for doc, text in ROWS:
        groups[text or ""].append(doc)
    expected = []
    for doc, text in ROWS:
        own = groups[text or ""]
        keep = max((d for d in own if d is not None), default=None)
        expected.append((doc, keep, len(own), sha(text or "")))
    found = exact_dedup.exact_groups(docs)
    rows = found.select("doc_id", "keep_id", "group_size", "text_sha256").collect()
    assert _sorted(rows) == _sorted(expected)
    kept = exact_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_chunks_cover_and_move_with_content():
    data = random.Random(0).randbytes(100_000)
    parts = exact_dedup.chunks(data)
    assert b"".join(parts) == data
    assert max(map(len, parts)) <= exact_dedup.MAX_CHUNK
    moved = exact_dedup.chunks(b"some bytes before" + data)
    assert len(set(parts) & set(moved)) > len(parts) * 0.8
    assert exact_dedup.chunks(b"") == []


def test_jaccard_components(docs):
    found = shingle_join.jaccard_components(docs).collect()
    assert _sorted(found) == _sorted(jaccard(ROWS))
    assert shingle_join.jaccard_components(docs.limit(0)).count() == 0
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns
    heads = {c for d, n, c in jaccard(ROWS) if n and c is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    blank = [d for d, t in ROWS if not shingles(t)]
    assert sorted(i for i in ids if i is not None) == sorted([*heads, *blank])


def test_unlike_components_with_one_name_or_none(spark):
    near = " ".join(_edited(BASE, 1, 1))
    rows = [
        (None, "one text without an id at all"),
        (None, "one text without an id at all"),
        (None, "quite another text that has none either"),
        (None, " ".join(BASE)),
        (None, near),
        (5, "the first of two unlike texts"),
        (5, "and here is the second one of them"),
        (6, "twice the same words for one id"),
        (6, "twice the same words for one id"),
        (7, LONG),
        (8, LONG + " tail"),
        (None, LONG),
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = shingle_join.one_of_each(table).collect()
    assert _sorted(kept) == _sorted([*rows[:7], rows[8], rows[9]])


def test_frequent_tokens_and_matches_change_no_result(docs, monkeypatch):
    for most, frequent, rounds in ((1, 3, 0), (4, 1, 1)):
        monkeypatch.setattr(shingle_join, "MOST_MATCHES", most)
        monkeypatch.setattr(shingle_join, "FREQUENT_TOKENS", frequent)
        monkeypatch.setattr(shingle_join, "LEADER_ROUNDS", rounds)
        found = shingle_join.jaccard_components(docs).collect()
        assert _sorted(found) == _sorted(jaccard(ROWS))


def _last_round(monkeypatch, table):
    """The result, and the pairs that the last round verified."""
    verified, pairs = shingle_join.JaccardJoin.verified, []

    def counted(self, rows):
        pairs.append(rows.count())
        return verified(self, rows)

    monkeypatch.setattr(shingle_join.JaccardJoin, "verified", counted)
    return shingle_join.jaccard_components(table).collect(), pairs[-1]


def test_near_copies_without_links_are_not_paired(spark, monkeypatch):
    # Each is two edits away from a text that is not in the table.
    copies = [_edited(BASE, 100 + i, 2) for i in range(120)]
    linked_to_one = [_edited(copies[i], 300 + i, 1) for i in range(10)]
    rows = [(i, " ".join(words)) for i, words in enumerate(copies + linked_to_one)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found, pairs = _last_round(monkeypatch, table)
    assert _sorted(found) == _sorted(jaccard(rows))
    # All of them are some 8,000 pairs.
    assert pairs < 10 * len(rows)


def test_stars_lose_no_link(spark, monkeypatch):
    # Chains of edits whose first texts are left out, a passage of many unlike texts,
    # sets that agree in other word orders, and texts of other lengths.
    draw, rows = random.Random(5), []
    for line in range(12):
        words = _edited(BASE, 500 + line, 4)
        for step in range(6):
            words = _edited(words, 600 + 10 * line + step, draw.randint(1, 2))
            cut = words[: draw.randint(100, 120)]
            rows.append(" ".join(cut))
            rows += [" ".join(cut[60:] + cut[:60])] * draw.randint(0, 1)
    rows += [PASSAGE + " " + " ".join(_words(900 + i, draw.randint(4, 30))) for i in range(40)]
    cycle = _words(8, 30)
    rows += [" ".join((cycle + cycle + cycle)[i : i + 64]) for i in range(3)]
    rows = list(enumerate(rows))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    expected = _sorted(jaccard(rows))
    for postings, frequent, rounds in ((0, 400_000, 0), (2, 5, 1), (16, 400_000, 0)):
        monkeypatch.setattr(shingle_join, "PAIRED_POSTINGS", postings)
        monkeypatch.setattr(shingle_join, "FREQUENT_TOKENS", frequent)
        monkeypatch.setattr(shingle_join, "LEADER_ROUNDS", rounds)
        found = shingle_join.jaccard_components(table).collect()
        assert _sorted(found) == expected


def _removed(docs):
    rows = suffix_dedup.remove_repeats(docs).collect()
    return _sorted(
        (r["doc_id"], r["n_bytes"], sum(s["to"] - s["from"] for s in r["spans"]), len(r["spans"]),
         bytes(r["kept"]))
        for r in rows
    )


def test_repeats(docs):
    assert _removed(docs) == _sorted(repeats(ROWS))
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    short = suffix_dedup.documents_without_repeats(docs)
    assert short.columns == docs.columns
    texts = {r[0]: r[1] for r in short.collect()}
    assert texts[1] is None and texts[9] == "" and texts[4] == "a b c"


def test_hot_anchors_give_the_same_repeats(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    assert _removed(docs) == _sorted(repeats(ROWS))


def test_run_length_index_on_small_alphabets():
    draw = random.Random(5)
    for _ in range(30):
        contexts = [
            bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 40))) for _ in range(6)
        ]
        places = defaultdict(int)
        for c in contexts:
            for s in range(len(c) - 6):
                places[c[s : s + 7]] += 1
        found = suffix_dedup.repeated_starts(contexts, 7)
        for c, flags in zip(contexts, found):
            assert flags.tolist() == [places[c[s : s + 7]] > 1 for s in range(len(c) - 6)]


def test_packing(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    found = packing.packed_documents(docs, path).collect()
    counted = defaultdict(int)
    for _, text in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END_TOKEN]
        for k, (s, n) in enumerate(packing.cut(len(ids))):
            crc = zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())
            counted[k, s, n, crc] += 1
    for r in found:
        counted[r["piece"], r["start"], r["length"], r["ids_crc32"]] -= 1
    assert not any(counted.values())
    _check_sequences(found)
    assert packing.packed_documents(docs.limit(0), path).count() == 0


def test_added_tokens_inside_texts(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"{end}\n\n x  {end}  ", "<|endoftext", f"<{end}>", "word " * 2000 + end]
    expected = []
    for i, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, packing.END_TOKEN]
        for k, (s, n) in enumerate(packing.cut(len(ids))):
            expected.append((i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())))
    assert library.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    for rows in (packing.op5_query(spark, tmp_path), packing_stage(spark, table, tmp_path)):
        found = rows.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
        assert _sorted(found) == _sorted(expected)


def _check_sequences(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    return len(sequences)


def test_partitions_with_gaps_are_packed_again(spark):
    draw = random.Random(1)
    lengths = [draw.choice([300, 350, 400, 520, 600, 1024]) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack_pieces(pieces, partition_pieces=200).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    bound = packing.lower_bound(np.bincount(lengths, minlength=1025))
    _, _, room = packing.best_fit_decreasing(np.array(lengths))
    assert bound <= len(room)
    assert _check_sequences(rows) <= len(room) * 1.01


def test_rounds_go_on_while_they_lower_the_bins(spark):
    # Sizes that no bound certifies; eight rounds were not enough for partitions so small.
    draw = random.Random(1)
    lengths = [draw.randint(257, 420) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack_pieces(pieces, partition_pieces=30).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    _, _, room = packing.best_fit_decreasing(np.array(lengths))
    assert _check_sequences(rows) <= len(room) * 1.005


def test_lower_bounds_hold():
    draw = random.Random(2)

    def optimum(items, bins):
        if not items:
            return True
        tried = set()
        for i, room in enumerate(bins):
            if room >= items[0] and room not in tried:
                tried.add(room)
                if optimum(items[1:], [*bins[:i], room - items[0], *bins[i + 1 :]]):
                    return True
        return False

    for _ in range(40):
        items = sorted((draw.randint(1, 20) for _ in range(8)), reverse=True)
        best = next(k for k in range(1, 9) if optimum(items, [20] * k))
        assert packing.lower_bound(np.bincount(items, minlength=21), 20) <= best


def test_shards_fit(spark, docs):
    rows = sharding.extendible_shards(docs, limit=4000).collect()
    assert len(rows) == len(ROWS)
    shards = defaultdict(list)
    for r in rows:
        shards[r["depth"], r["bucket"], r["piece"]].append(r["n_bytes"])
    assert all(sum(s) <= 4000 or len(s) == 1 for s in shards.values())
    hot = spark.range(500).selectExpr("7L as doc_id", "repeat('x', 100) as text")
    parts = sharding.extendible_shards(hot, limit=4000).groupBy("depth", "bucket", "piece")
    assert parts.agg(F.sum("n_bytes").alias("b")).filter("b > 4000").isEmpty()
    assert sharding.extendible_shards(docs.limit(0)).count() == 0


def _place(bits, sizes, limit):
    """``(depth, bucket)`` of the first level whose bucket fits, None beyond 60 bits."""
    for depth in range(61):
        bucket = bits >> (60 - depth)
        if sum(n for b, n in sizes if b >> (60 - depth) == bucket) <= limit:
            return depth, bucket
    return None


def test_shards_as_brute_force_at_every_depth(spark):
    def bits(doc):
        return int(hashlib.md5(b"null" if doc is None else str(doc).encode()).hexdigest()[:15], 16)

    draw = random.Random(4)
    rows = [(i, "x" * draw.randint(0, 300)) for i in range(400)]
    # Ids that share more than 20 bits, and rows that fit no bucket.
    ids = sorted(range(1_000, 40_000), key=bits)
    a, b = min(zip(ids, ids[1:]), key=lambda p: bits(p[0]) ^ bits(p[1]))
    assert (bits(a) ^ bits(b)).bit_length() < 40
    rows += [(a, "y" * 300), (b, "y" * 300), (500, "z" * 700), (501, "z" * 600)]
    rows += [(502, "w" * 200)] * 5 + [(None, None)]
    limit = 500
    sizes = [(bits(i), len(t or "")) for i, t in rows]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sharding.extendible_shards(table, limit=limit).collect()
    places = [_place(bits(i), sizes, limit) for i, _ in rows]
    expected = [
        (i, len(t or ""), *(place or (60, bits(i)))) for (i, t), place in zip(rows, places)
    ]
    assert None in places and max(p[0] for p in places if p) > 20
    assert _sorted((r["doc_id"], r["n_bytes"], r["depth"], r["bucket"]) for r in found) == _sorted(
        expected
    )
    pieces = defaultdict(list)
    for r in found:
        pieces[r["depth"], r["bucket"], r["piece"]].append(r["n_bytes"])
    assert all(sum(p) <= limit or len(p) == 1 for p in pieces.values())


def test_near_vectors(spark):
    draw = np.random.default_rng(3)
    centre = draw.normal(size=(6, 16))
    rows = [(i, (centre[i % 6] + draw.normal(size=16) * 0.12).tolist()) for i in range(150)]
    rows += [(200, None), (201, []), (202, [0.0] * 16), (203, [float("nan")] * 16)]
    rows += [(204, [None] * 16), (205, [float("inf")] * 16), (206, [1.0, 2.0]), (207, [2.0, 4.0])]
    rows += [(300 + i, rows[0][1]) for i in range(20)] + [(300, rows[1][1]), (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert _sorted(near_vectors.near_duplicates(table).collect()) == _sorted(_vectors(rows))
    assert near_vectors.near_duplicates(table.limit(0)).count() == 0


def _vectors(rows):
    from brute import Groups

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    units = [unit(v) if i is not None else None for i, v in rows]
    groups, links = Groups(), [0] * len(rows)
    for i, a in enumerate(units):
        groups.find(i)
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and units[i] is not None:
            root = groups.find(i)
            least[root] = min(least.get(root, doc), doc)
    return [
        (doc, links[i], least.get(groups.find(i), doc) if doc is not None else None)
        for i, (doc, _) in enumerate(rows)
    ]


def test_small_blocks_find_the_same_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 20)
    test_near_vectors(spark)


def test_components_of_long_chains(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b")
    found = components(edges.union(spark.createDataFrame([(900, 901)], "a long, b long"))).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def _verdict(url):
    import re

    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = host.encode().lower().decode()
    rule = max(
        (
            h + p
            for _, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ),
        key=len,
        default=None,
    )
    return host, path, rule


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/1", "http://net/", "x://net"]
    urls += ["http://example.net/en", "http://b.example.net/en/?q=://z", "http://notnet/x", "s://org/fr/"]
    urls += ["http://a.org/fr/1#f", "http://example.com/de/", "http://example.com?x=/de/", "h://A\u00c9.net/"]
    urls += [f"http://h{i}.example.{t}/{p}/{i}" for i in range(20) for t in ("net", "com", "org") for p in ("en", "fr", "de")]
    rows = [(i, u, "p") for i, u in enumerate(urls)] + [(0, None, "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_filter.judge_urls(pages).collect()
    assert _sorted((r["page_id"], r["host"], r["path"], r["rule"]) for r in found) == _sorted(
        (i, *_verdict(u)) for i, u, _ in rows
    )
    kinds = {h + p: k for k, h, p in url_filter.RULES}
    assert all(r["verdict"] == kinds[r["rule"]] for r in found if r["rule"])
    assert {r["verdict"] for r in found} <= {"allow", "block"}
    unlabelled = url_filter.judge_urls(pages.filter("url is null")).collect()
    assert [r["verdict"] for r in unlabelled] == ["allow", "allow"]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_repeated_url_does_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TRAIN_URLS", 40)
    monkeypatch.setattr(url_filter, "LEAST_URLS", 10, raising=False)
    kinds = (("block", "net", "/a/"), ("allow", "org", "/b/"))
    known = [f"http://h{i}.site.{h}{p}{i}" for i in range(60) for _, h, p in kinds]
    table = spark.createDataFrame([(u,) for u in known], "url string")
    hot = table.orderBy(F.xxhash64("url")).first()["url"]
    asked = {f"http://u{i}.site.{h}{p[:-1]}": v for i in range(10) for v, h, p in kinds}
    rows = list(enumerate([*known, *[hot] * 400, *asked]))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = url_filter.judge_urls(pages, rules=kinds).filter("rule is null").collect()
    assert {r["url"]: r["verdict"] for r in found} == asked


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def _held_out_accuracy(scored, labels, label, cut, folds, fold):
    from loglens.llm.labelled import held_out

    row = (
        scored.join(labels, "doc_id")
        .filter(held_out(F.col("doc_id"), folds, fold))
        .agg(F.avg(((F.col("score") >= cut).cast("int") == F.col(label)).cast("int")).alias("a"))
    )
    return row.first()["a"]


@pytest.mark.parametrize("n1, n0", [(5_000, 5_000), (6_000, 4_000), (7_919, 12), (1, 40), (1, 1)])
def test_preference_pairs_differ_and_use_every_document(spark, n1, n0):
    drawn = min(quality.PAIRS, 8 * max(n1, n0))
    pairs = quality.preference_pairs(spark.range(drawn), n1, n0).collect()
    assert len({(r["hi"], r["lo"]) for r in pairs}) == len(pairs)
    assert {r["hi"] for r in pairs} <= set(range(n1)) and {r["lo"] for r in pairs} <= set(range(n0))
    larger = "hi" if n1 >= n0 else "lo"
    assert {r[larger] for r in pairs} == set(range(max(n1, n0)))
    # As many pairs as there are, or nearly as many as were drawn.
    assert len(pairs) >= 0.6 * min(drawn, n1 * n0)


def test_quality_on_held_out_rows(docs, corpus):
    state = quality.train(*corpus)
    scored = quality.score_documents(corpus[0], state)
    assert _held_out_accuracy(scored, corpus[1], "quality", 0.7, 4, 2) > 0.95
    found = quality.score_documents(docs, state).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert by_id[1] == by_id[2]
    nothing = quality.train(corpus[0], corpus[1].limit(0))
    assert {r["score"] for r in quality.score_documents(docs, nothing).collect()} == {1.0}
    assert quality.score_documents(docs.limit(0), state).count() == 0


def test_toxicity_on_held_out_rows(spark, docs, corpus):
    state = toxicity.train(*corpus)
    scored = toxicity.score_documents(corpus[0], state)
    assert _held_out_accuracy(scored, corpus[1], "toxic", 0.5, 5, 0) > 0.95
    # Gaps and inserted characters.
    texts = ["you idiot", "you id-iot", "you idxiot", "you i d i o t", "nothing here of the kind"]
    some = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = [r["score"] for r in toxicity.score_documents(some, state).orderBy("doc_id").collect()]
    assert min(scores[:4]) > scores[4]
    assert scores[0] >= 0.5 and scores[3] >= 0.5 and scores[4] < 0.5
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, state).collect()}
    assert found[1] == found[2] == found[3] < 0.5
    kept = toxicity.without_toxic(docs, state)
    assert kept.columns == docs.columns
    assert toxicity.train(corpus[0], corpus[1].limit(0)) is None
    assert {r["score"] for r in toxicity.score_documents(docs, None).collect()} == {0.0}
