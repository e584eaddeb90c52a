"""The Merkle manifest and the conversation repair against plain versions."""

import hashlib
import itertools
import random
import zlib

import pytest

from loglens.llm import conversations, merkle

SCHEMA = "doc_id bigint, text string, TEXT string, lang string, source string, n_chars bigint, node int"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, more=0):
    doc, text, lang, source, chars = row
    values = (doc, source, lang, None if chars is None else chars + more, text)
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def _path(levels, at):
    for level in levels[:-1]:
        run = level[at & ~1 : (at & ~1) + 2]
        yield at & 1, run
        at >>= 1


def _manifest(rows):
    langs = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r))):
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = [_tree([_leaf(r) for r in langs[lang]]) for lang in order]
    top = _tree([t[-1][0] for t in trees])
    root = top[-1][0]
    for i, lang in enumerate(order):
        for j, row in enumerate(langs[lang]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node, siblings = _leaf(row, 1 if tampered else 0), ""
            for side, run in itertools.chain(_path(trees[i], j), _path(top, i)):
                run = list(run)
                siblings += "".join(run[:side] + run[side + 1 :])
                run[side] = node
                node = _sha("".join(run))
            yield row[0], _leaf(row), trees[i][-1][0], root, _sha(siblings), node, node == root


def _documents(n, langs):
    draw = random.Random(n)
    rows = [
        (draw.choice([i, i, 3]), "t" * draw.randrange(9), draw.choice(langs), "s", draw.choice([5, None]))
        for i in range(n)
    ]
    rows += [(None, None, None, None, None), (None, "é", "en", None, 2**63 - 1)]
    rows += [(7, "", "en", "", 0)] * 5 + [(9, "long " * 200_000, "é", "s", 1_000_000)]
    return rows


@pytest.mark.parametrize("n", [0, 1, 2, 70])
@pytest.mark.parametrize("levels", [1, 10])
def test_manifest(spark, monkeypatch, tmp_path, n, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    rows = _documents(n, ["en", "de", "EN", "", None, *[f"l{i}" for i in range(6)]])
    spark.conf.set("spark.sql.caseSensitive", "true")
    table = [(d, t, "x", lang, s, c, 1) for d, t, lang, s, c in rows]
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = merkle.op13_query(spark, str(tmp_path)).collect()
    spark.conf.set("spark.sql.caseSensitive", "false")
    assert sorted(map(tuple, found), key=repr) == sorted(_manifest(rows), key=repr)


def test_manifest_of_nothing(spark):
    table = spark.createDataFrame([], SCHEMA)
    leaves = merkle.merkle_leaves(table, merkle.FIELDS)
    assert merkle.merkle_proofs(leaves).count() == 0


def test_proof_folds_to_the_root(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "de", "s", i, "x", 0) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n_chars int, other string, node int")
    for row in merkle.merkle_proofs(merkle.merkle_leaves(table, merkle.FIELDS)).collect():
        assert row["verified"]
        assert merkle.folded(row["leaf"], row["digests"], row["sides"]) == row["root"]
        assert merkle.folded(_sha("other"), row["digests"], row["sides"]) != row["root"]


WHITE = " \t\n\x0b\x0c\r"
LEGAL_NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def _after_damage(rows):
    kept = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        spot = zlib.crc32(name.encode()) % 20
        if spot == 1:
            text = ""
        if spot == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if spot == 4:
            role = "user"
        kept += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(spot, 1)
    return sorted(kept, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def _cheapest(turns):
    """``(cost, audit, lines)`` by the least of all audits, compared as strings.

    ``turns`` are ``(role, text, fault)``. Every state keeps its least pair of cost and
    audit after each turn.
    """
    best = {"": (0, "", [])}
    full = {"u": "user", "a": "assistant"}
    for role, text, fault in turns:
        new = {}

        def offer(state, cost, audit, lines):
            if state not in new or (cost, audit) < new[state][:2]:
                new[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in best.items():
            for _ in range(3):
                offer(state, cost + 4, audit + "D", lines)
                if fault not in ("blank", "duplicate"):
                    more = 3 if fault == "truncated" else 0
                    if role[:1] and role[:1] in LEGAL_NEXT[state]:
                        offer(role[:1], cost + more, audit + "K", [*lines, f"{role}:{text}"])
                    to = LEGAL_NEXT[state][-1]
                    offer(to, cost + 3 + more, audit + "R", [*lines, f"{full[to]}:{text}"])
                state = LEGAL_NEXT[state][-1]
                cost, audit, lines = cost + 3, audit + "I", [*lines, f"{full[state]}:"]
        best = new
    ends = []
    for state, (cost, audit, lines) in best.items():
        while state not in ("", "a"):
            state = LEGAL_NEXT[state][-1]
            cost, audit, lines = cost + 3, audit + "I", [*lines, f"{full[state]}:"]
        ends.append((cost, audit, lines))
    return min(ends, key=lambda e: e[:2])


def _enumerated(turns):
    """The same for a few turns, from all audits with at most two turns inserted at a place."""
    best = None
    pieces = ["I" * k + e for k in range(3) for e in "DKR"]
    for audit in itertools.product(pieces, repeat=len(turns)):
        for tail in ("", "I", "II"):
            state, cost, at = "", 0, 0
            for edit in "".join(audit) + tail:
                role, text, fault = turns[at] if at < len(turns) else ("", "", "")
                if edit != "I":
                    at += 1
                if edit == "D":
                    cost += 4
                    continue
                if edit in "KR" and fault in ("blank", "duplicate"):
                    break
                cost += {"I": 3, "K": 0, "R": 3}[edit] + (3 if edit != "I" and fault == "truncated" else 0)
                to = role[:1] if edit == "K" else LEGAL_NEXT[state][-1]
                if not to or to not in LEGAL_NEXT[state]:
                    break
                state = to
            else:
                if state in ("", "a"):
                    found = (cost, "".join(audit) + tail)
                    best = found if best is None else min(best, found)
    return best


def _faults(rows):
    seen, made = set(), []
    for _, _, role, text in rows:
        core = text.rstrip(WHITE)
        if not core:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        made.append((role, text, fault))
    return made


def _report(conv, rows):
    rows = _after_damage(rows)
    turns = _faults(rows)
    known = [r[1] for r in rows if r[1] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, lines = _cheapest(turns)
    counts = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (conv, gaps, *counts, illegal, cost, audit, _sha("\n".join(lines)))


def _conversations(seed, n):
    draw = random.Random(seed)
    texts = ["Yes.", "Yes.", "no", "Why?", "", None, " \t", "a. b! c?", "été.", "so..."]
    for conv in range(n):
        for turn in range(draw.choice([1, 2, 3, 5, 9, 40])):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            yield conv, draw.choice([turn, turn, turn + 1, None]), role, draw.choice(texts)


def _check(spark, tmp_path, rows):
    schema = "conv_id bigint, turn bigint, role string, text string, Role int, nth int, edit string"
    spark.conf.set("spark.sql.caseSensitive", "true")
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema)
    table.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = conversations.op12_query(spark, str(tmp_path)).collect()
    spark.conf.set("spark.sql.caseSensitive", "false")
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    expected = {conv: _report(conv, members) for conv, members in groups.items()}
    assert len(found) == len(expected)
    for row in found:
        assert tuple(row) == expected[row["conv_id"]]


@pytest.mark.parametrize("shift", [1, 10])
def test_repair(spark, monkeypatch, tmp_path, shift):
    monkeypatch.setattr(conversations, "SHIFT", shift)
    monkeypatch.setattr(conversations, "BLOCK", 1 << shift)
    rows = list(_conversations(shift, 60))
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (None, 2, "assistant", "x" * 10**6)]
    rows += [(1000 + i, 0, "user", "One.") for i in range(40)]
    rows += [(5000, i, "user" if i % 3 else "assistant", f"{i % 7}.") for i in range(300)]
    _check(spark, tmp_path, rows)


def test_repair_of_the_table(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    _check(spark, tmp_path, [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


def test_repair_of_nothing(spark, tmp_path):
    _check(spark, tmp_path, [])


def test_least_audit_of_all():
    draw = random.Random(5)
    faults = ["", "", "", "truncated", "blank", "duplicate"]
    names = ["system", "user", "assistant", "tool"]
    codes = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for _ in range(60):
        turns = [(draw.choice(names), "t", draw.choice(faults)) for _ in range(draw.randrange(4))]
        steps = [conversations.turn_step(4 * names.index(r) + codes[f]) for r, _, f in turns]
        end = conversations.last_state(conversations.composed(steps))
        states = conversations.crossings(steps, conversations.START, end)
        ways = [
            conversations.turn_edits(4 * names.index(r) + codes[f])[a, b]
            for (r, _, f), a, b in zip(turns, states, states[1:])
        ]
        tail = conversations.TAIL[end]
        mine = (sum(w[0] for w in ways) + 3 * tail, "".join(w[1] for w in ways) + "I" * tail)
        assert mine == _enumerated(turns) == _cheapest(turns)[:2]
