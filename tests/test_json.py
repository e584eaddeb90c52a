import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglens import session
from loglens.functions import flatten as event_reader
from loglens.operators import jsonflat
from loglens.sinks.files import json_to_csv, union_header_csv


def brute_force(value):
    """Leaves as (key, path, text), by the rules stated in the module."""
    leaves = []

    def of_object(members, prefix, path):
        for key, member in members.items():
            here = (*path, key)
            if isinstance(member, dict):
                of_object(member, prefix, here)
            elif isinstance(member, list):
                of_list(member, key, here)
            elif member is not None and member != "null":
                leaves.append((prefix + key, here, text(member)))

    def of_list(members, prefix, path):
        for i, member in enumerate(members):
            here = (*path, i)
            if isinstance(member, list):
                of_list(member, f"{prefix}{i}", here)
            elif isinstance(member, dict):
                of_object(member, f"{prefix}{i + 1}", here)
            elif member is not None:
                leaves.append((f"{prefix}{i + 1}", here, text(member)))

    def text(scalar):
        return scalar if isinstance(scalar, str) else json.dumps(scalar)

    of_object(value, "", ())
    flat = {}
    for key, _, value in sorted(leaves, key=lambda leaf: leaf[:2]):
        flat[key] = value
    return flat, len(leaves) - len(flat)


def flatten(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, doc string")
    good, bad = jsonflat.flatten_json(df, "id", "doc")
    rows = {(r["id"], r["element"]): (r["flat"], r["collisions"]) for r in good.collect()}
    return rows, {r["id"]: r["reason"] for r in bad.collect()}


CASES = [
    ('{"a":"x","b":{"c":"y"}}', {"a": "x", "c": "y"}),
    ('{"d":["p","q"]}', {"d1": "p", "d2": "q"}),
    ('{"d":[["p","q"],["r"]]}', {"d01": "p", "d02": "q", "d11": "r"}),
    ('{"d":[{"e":"x"},{"e":"y"}]}', {"d1e": "x", "d2e": "y"}),
    ('{"a":[],"b":null,"c":"z","n":"null","l":["null",null]}', {"c": "z", "l1": "null"}),
    (
        '{"z":{"b":1,"c":null},"d":[1,[2,3],{"e":"x","g":{"h":true}}],"f":"y","em":[]}',
        {"b": "1", "d1": "1", "d11": "2", "d12": "3", "d3e": "x", "d3h": "true", "f": "y"},
    ),
    ('{"a":{"k":"1"},"b":{"k":"2"}}', {"k": "2"}),
    ("{}", {}),
    ('{"t":"brackets [{ in \\"text\\""}', {"t": 'brackets [{ in "text"'}),
]


def test_known_documents(spark):
    rows, bad = flatten(spark, *[text for text, _ in CASES])
    assert not bad
    for i, (text, expected) in enumerate(CASES):
        assert rows[i, 0][0] == expected
        assert rows[i, 0] == brute_force(json.loads(text))


def test_arrays_and_quarantine(spark):
    rows, bad = flatten(
        spark, '[{"a":"1"},{"b":"2,3"}]', "{bad", None, "[1,2]", '"text"', "[]", "null"
    )
    assert rows == {(0, 0): ({"a": "1"}, 0), (0, 1): ({"b": "2,3"}, 0)}
    assert bad == {
        1: "malformed JSON",
        2: "missing text",
        3: "neither an object nor an array of objects",
        4: "neither an object nor an array of objects",
        6: "neither an object nor an array of objects",
    }


def test_deep_document(spark):
    deep = {"leaf": "x"}
    for i in range(60):
        deep = {f"k{i}": deep} if i % 2 else {f"k{i}": [deep]}
    text = json.dumps(deep)
    rows, bad = flatten(spark, text)
    assert not bad and rows[0, 0] == brute_force(deep)


def test_long_text_is_kept_whole(spark):
    value = 'line\n"quoted"\\ ' * 50_000
    rows, _ = flatten(spark, json.dumps({"a": [{"text": value}]}))
    assert rows[0, 0][0] == {"a1text": value}


_keys = st.text(alphabet="abc1", min_size=1, max_size=2)
_scalars = st.one_of(
    st.none(), st.booleans(), st.integers(-1000, 1000), st.sampled_from(["x", "null", "", "[{"])
)
_values = st.recursive(
    _scalars, lambda v: st.lists(v, max_size=3) | st.dictionaries(_keys, v, max_size=3), max_leaves=8
)
_objects = st.dictionaries(_keys, _values, max_size=4)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(documents=st.lists(_objects, min_size=40, max_size=40))
def test_against_brute_force(spark, documents):
    rows, bad = flatten(spark, *[json.dumps(d) for d in documents])
    assert not bad
    for i, document in enumerate(documents):
        assert rows[i, 0] == brute_force(document), document


def test_wide_and_lines(spark, tmp_path):
    df = spark.createDataFrame(
        [(0, '[{"a":"1"},{"b":"2,3"}]'), (1, '{"a":"4"}'), (2, "{bad")], "id int, doc string"
    )
    flat, _ = jsonflat.flatten_json(df, "id", "doc")
    wide = jsonflat.flat_wide(flat).orderBy("id", "element")
    assert wide.columns == ["id", "element", "a", "b"]
    assert [(r["a"], r["b"]) for r in wide.collect()] == [("1", ""), ("", "23"), ("4", "")]
    expected = [(0, "a,b"), (1, "1,"), (2, ",23"), (3, "4,")]
    for limit in (None, 1):
        lines = jsonflat.csv_lines(flat, "id", single_task_rows=limit).orderBy("line_no")
        assert [tuple(r) for r in lines.collect()] == expected
    path = str(tmp_path / "csv")
    bad = json_to_csv(df, "id", "doc", path)
    assert bad.count() == 1
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["a", "b"] and back.count() == 3
    long = jsonflat.flat_long(flat).orderBy("id", "element")
    assert [tuple(r) for r in long.collect()] == [
        (0, 0, "a", "1"),
        (0, 1, "b", "2,3"),
        (1, 0, "a", "4"),
    ]


def test_too_many_columns_are_refused(spark, monkeypatch):
    monkeypatch.setattr(jsonflat, "MAX_COLUMNS", 2)
    df = spark.createDataFrame([(0, '{"a":1,"b":2,"c":3}')], "id int, doc string")
    flat, _ = jsonflat.flatten_json(df, "id", "doc")
    with pytest.raises(ValueError):
        jsonflat.flat_wide(flat)
    assert jsonflat.csv_lines(flat, "id").filter(F.col("line_no") == 1).first()["line"] == "1,2,3"


def test_text_details(spark):
    rows, bad = flatten(
        spark,
        '{"n":1.50,"big":123456789012345678901234567890,"e":1E5,"s":"\\ud800x","t":true}',
        '{"k":"1","k":"2"}',
        '{"x":NaN}',
        "[" * 500_000 + "]" * 500_000,
    )
    assert rows[0, 0][0] == {
        "n": "1.50",
        "big": "123456789012345678901234567890",
        "e": "1E5",
        "s": "�x",
        "t": "true",
    }
    assert rows[1, 0] == ({"k": "2"}, 1)
    assert bad[2] == "malformed JSON" and bad[3] == "neither an object nor an array of objects"


def _event_result(text):
    try:
        return event_reader.read_objects(text)
    except ValueError:
        return None, event_reader.MALFORMED


@settings(max_examples=300, deadline=None)
@given(
    document=_values | st.lists(_objects, max_size=3),
    cut=st.integers(0, 60),
    put=st.sampled_from(["", ",", "}", "]", '"', "1", " "]),
    indent=st.sampled_from([None, 1]),
)
def test_event_reader_equals_the_tree(document, cut, put, indent):
    decoder = event_reader.make_decoder()
    text = json.dumps(document, indent=indent).replace('"b"', '"a"')
    for t in (text, text[:cut] + put + text[cut + 1 :]):
        assert _event_result(t) == event_reader.flat_objects(t, decoder)


def test_any_depth(spark):
    depth = 100_000
    rows, bad = flatten(
        spark,
        '{"k":' * depth + "[[1]]" + "}" * depth,
        '{"k":' + "[" * depth + "7" + "]" * depth + "}",
        '{"k":' * depth + "1" + "}" * (depth - 1),
    )
    assert rows[0, 0] == ({"k01": "1"}, 0)
    ((key, value),) = rows[1, 0][0].items()
    assert key == "k" + "0" * (depth - 1) + "1" and value == "7"
    assert bad == {2: "malformed JSON"}


def test_long_document_without_a_tree(monkeypatch):
    text = json.dumps({"r": [{"i": i, "x": {"y": [i, "null", None]}} for i in range(20_000)]})
    decoder = event_reader.make_decoder()
    plain = event_reader.flat_objects(text, decoder)
    monkeypatch.setattr(event_reader, "WHOLE_TEXT", 1_000)
    monkeypatch.setattr(event_reader, "parse_objects", None)
    assert event_reader.flat_objects(text, decoder) == plain


def _written(spark, tmp_path, documents, **options):
    df = spark.createDataFrame(list(enumerate(documents)), "id int, doc string")
    flat, _ = jsonflat.flatten_json(df, "id", "doc")
    path = str(tmp_path / "out")
    union_header_csv(session.written(flat, "flat"), path, **options)
    back = spark.read.option("header", True).option("multiLine", True).option("maxColumns", 60_000).csv(path)
    return [p for p in (tmp_path / "out").glob("part*") if p.stat().st_size], back


def test_any_number_of_keys(spark, tmp_path):
    documents = [json.dumps({f"k{(i * 500 + j):05}": f"{i}-{j}" for j in range(500)}) for i in range(100)]
    files, back = _written(spark, tmp_path, documents, part_bytes=2_000_000)
    assert len(files) > 1
    assert back.columns == [f"k{i:05}" for i in range(50_000)]
    lines = [line for f in files for line in f.read_text().split("\n")[1:] if line]
    assert len(lines) == 100 and {line.count(",") for line in lines} == {49_999}
    for line in lines:
        cells = line.split(",")
        filled = [i for i, cell in enumerate(cells) if cell]
        first = filled[0]
        assert filled == list(range(first, first + 500)) and first % 500 == 0
        assert [cells[i] for i in filled] == [f"{first // 500}-{j}" for j in range(500)]


def test_cells_are_read_back_whole(spark, tmp_path):
    documents = [
        json.dumps({"a": 'say "x"\\ \n end', "b,c": "1,2", "B": "  wide  "}),
        json.dumps({}),
        json.dumps({"b": "", "z\"": "back\\slash"}),
    ]
    _, back = _written(spark, tmp_path, documents)
    # The reader tells columns apart that differ in case only.
    assert [c[:1] for c in back.columns] == ["B", "a", "b", "b", "z"]
    rows = sorted((tuple(r) for r in back.collect()), key=repr)
    assert sorted(rows, key=repr) == sorted(
        [
            ("  wide  ", 'say "x"\\ \n end', None, "12", None),
            (None,) * 5,
            (None, None, None, None, "back\\slash"),
        ],
        key=repr,
    )


def test_one_key_and_none(spark, tmp_path):
    _, back = _written(spark, tmp_path, ['{"a":"x"}', "{}", '{"a":""}'])
    assert back.columns == ["a"] and back.count() == 3
    files, _ = _written(spark, tmp_path / "none", ['{"a":null}', "{}"])
    assert all(set(f.read_text()) <= set('"\n') for f in files)


def test_batches_are_cut_by_size(spark, monkeypatch):
    import pyarrow as pa

    texts = [json.dumps({"i": i, "pad": "x" * 100}) for i in range(50)]
    batch = pa.record_batch([list(range(50)), texts], names=["id", "text"])
    monkeypatch.setattr(jsonflat, "_PIECE_BYTES", 500)
    made = list(jsonflat._flatten_batches([batch]))
    assert len(made) > 5 and sum(b.num_rows for b in made) == 50
    assert [i for b in made for i in b.column(0).to_pylist()] == list(range(50))


def test_batch_function_needs_no_package_on_executors(tmp_path):
    import subprocess
    import sys

    import pyarrow as pa
    from pyspark import cloudpickle

    batch = pa.record_batch([[1], ['{"a":[1]}']], names=["id", "text"])
    (tmp_path / "f.bin").write_bytes(cloudpickle.dumps((jsonflat._flatten_batches, batch)))
    code = (
        "import sys, pickle; f, b = pickle.load(open('f.bin', 'rb'));"
        "print(next(f([b])).column(3).to_pylist(), any(m.startswith('loglens') for m in sys.modules))"
    )
    made = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env={}, capture_output=True, text=True, check=True
    )
    assert made.stdout.strip() == "[[('a1', '1')]] False"


def test_members_named_like_carried_columns_stay(spark, tmp_path):
    rows = [("k1", '{"element":"x","id":"7","b":"y"}'), ("k2", '{"ID2":"z","b":"w"}')]
    df = spark.createDataFrame(rows, "id string, doc string")
    path = str(tmp_path / "csv")
    json_to_csv(df, "id", "doc", path)
    back = spark.read.option("header", True).csv(path)
    assert sorted(back.columns) == ["ID2", "b", "element", "id"]
    found = {tuple(r[c] for c in ("ID2", "b", "element", "id")) for r in back.collect()}
    assert found == {(None, "y", "x", "7"), ("z", "w", None, None)}
    flat, _ = jsonflat.flatten_json(df, "id", "doc")
    wide = jsonflat.flat_wide(flat)
    assert wide.columns == ["_id", "_element", "ID2", "b", "element", "id"]
