"""Documents cut out of text files of any layout and split size."""

import json
import os
import random
import tempfile
from datetime import datetime

import pyarrow as pa
import pytest

from gaugeflow.sources import documents


def plain_brackets(text: str):
    """Bracket steps outside strings, character by character; strings end with their line."""
    out, inside, skip, open_end = [], False, False, False
    for i, c in enumerate(text):
        if c == "\n":
            open_end |= inside
            inside = skip = False
        elif skip:
            skip = False
        elif inside and c == "\\":
            skip = True
        elif c == '"':
            inside = not inside
        elif not inside and c in "{[}]":
            out.append((i, 1 if c in "{[" else -1))
    return out, open_end or inside


def test_brackets_follow_strings_escapes_and_lines():
    rng = random.Random(3)
    for _ in range(400):
        # Backslashes only inside strings, as in JSON.
        parts = [rng.choice(["{", "}", "[", "]", ",", "\n", " ", '"' + "".join(rng.choices(['\\\\', '\\"', "{", "x", "]"], k=rng.randint(0, 6))) + '"']) for _ in range(rng.randint(0, 40))]
        text = "".join(parts) + rng.choice(["", '"', '"{'])
        at, step, open_end = documents.brackets(text.encode())
        want, unclosed = plain_brackets(text)
        assert list(zip(at.tolist(), step.tolist())) == want and open_end == unclosed


def some_document(rng: random.Random, depth: int = 0):
    kind = rng.randint(0, 5 if depth < 4 else 2)
    if kind < 3:
        return rng.choice([None, True, -1.5, 12, "plain", 'br}ace"s\\', "[{", "line\nbreak", "é😀", ""])
    if kind == 3:
        return [some_document(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {f"k{i}": some_document(rng, depth + 1) for i in range(rng.randint(0, 4))}


@pytest.mark.parametrize("split", [1 << 20, 300, 48])
def test_documents_of_any_layout_and_split(spark, split):
    """Splits far smaller than a document: most lie inside one."""
    rng = random.Random(split)
    base, want = tempfile.mkdtemp(prefix="gf-docs-"), []
    for f in range(8):
        text = ""
        for _ in range(rng.choice([0, 1, 3, 12])):
            doc = {"id": len(want), "body": [some_document(rng) for _ in range(rng.choice([1, 5, 40]))]}
            want.append(json.dumps(doc, sort_keys=True))
            doc = doc if rng.random() < 0.7 else [doc]
            want[-1] = json.dumps(doc, sort_keys=True)
            text += json.dumps(doc, indent=rng.choice([None, None, 0, 2]), ensure_ascii=rng.random() < 0.5)
            text += rng.choice(["\n", "\r\n", "\n\n \t\n", "", " "])
        with open(f"{base}/{f}.json", "w", newline="") as out:
            out.write(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = [r["json"] for r in documents.read_documents(spark, base).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(json.dumps(json.loads(g), sort_keys=True) for g in got) == sorted(want)


def test_no_file_is_read_as_one_row(spark):
    base = tempfile.mkdtemp(prefix="gf-docs-")
    with open(f"{base}/a.json", "w") as f:
        f.write('{"a": 1}\n')
    found = documents.read_documents(spark, base)
    assert found.count() == 1
    assert "wholetext" not in documents.text_lines(spark.read.text(base))._jdf.queryExecution().toString().lower()


def test_a_broken_file_is_named_even_when_nothing_is_selected(spark):
    base = tempfile.mkdtemp(prefix="gf-docs-")
    for name, text in (("good", '{"a": 1}\n' * 50), ("bad", '{"a": [1}\n{"b": "x\n' + '{"a": 1}\n' * 50)):
        with open(f"{base}/{name}.json", "w") as f:
            f.write(text)
    for act in (lambda d: d.count(), lambda d: d.collect()):
        with pytest.raises(Exception, match="bad.json"):
            act(documents.read_documents(spark, base))
    os.remove(f"{base}/bad.json")
    assert documents.read_documents(spark, base).count() == 50
    empty = tempfile.mkdtemp(prefix="gf-docs-")
    open(f"{empty}/none.json", "w").close()
    assert documents.read_documents(spark, empty).collect() == []


def line_batches(texts, start: int):
    """Batches as a worker gets them, one a list of lines, and how many it has taken."""
    taken = []

    def batches():
        for lines in texts:
            taken.append(len(lines))
            n = len(lines)
            yield pa.record_batch([pa.array(["f"] * n), pa.array([datetime(2026, 6, 14)] * n), pa.array([start] * n), pa.array(lines)], ["file", "modified", "start", "value"])

    return batches(), taken


@pytest.mark.parametrize("start", [0, 12])
def test_a_worker_does_not_hold_its_split(start):
    """Also behind a file's start, where a later line may show that a cut was none, pieces
    leave before the next batch is read."""
    lines = [['{"a": [' + str(i) + '], "b": "' + "x" * 200 + '"}' for i in range(1000)] for _ in range(30)]
    batches, taken = line_batches(lines, start)
    seen = 0
    for piece in documents._cut(batches):
        seen += piece.column(4).to_pylist().count("document")
        assert piece.nbytes < 3 << 20
        assert seen >= 1000 * (len(taken) - 1)
    assert seen == 30_000


def test_a_cut_that_a_later_batch_disproves():
    """The split starts two levels deep: what ends at the first level is no document."""
    lines = [['1}, {"i": 2}, {"i": 3}'], [', {"i": 4}', "]"], ["}", '{"a": [{"i": 5}]}'], ['{"b": 6}', "{"]]
    rows = [r for b in documents._cut(line_batches(lines, 7)[0]) for r in b.to_pylist()]
    facts = rows.pop()
    assert (facts["role"], facts["lowest"], facts["change"], facts["broken"]) == ("facts", -3, -2, False)
    ends = [r["seq"] for r in rows if r["role"] == "head" and r["level"] == -3]
    assert [r["body"] for r in rows if r["role"] == "document" and r["level"] == -3] == [b'{"a": [{"i": 5}]}', b'{"b": 6}']
    before = b"".join(r["body"] for r in rows if r["seq"] <= ends[0])
    assert len(ends) == 1 and before.replace(b"\n", b"").replace(b" ", b"") == b'1},{"i":2},{"i":3},{"i":4}]}'
    assert (rows[-1]["role"], rows[-1]["body"].strip()) == ("tail", b"{")


def test_long_lines_are_looked_at_in_parts(monkeypatch):
    rng = random.Random(9)
    for size in (1, 2, 7, 30):
        monkeypatch.setattr(documents, "BLOCK", size)
        for _ in range(100):
            docs = [some_document(rng) for _ in range(rng.randint(1, 6))]
            lines = [json.dumps({"d": d, "s": "\\" * rng.randint(0, 5)}) + " " * rng.randint(0, 3) for d in docs]
            parts = list(documents._blocks(pa.array([x.encode() for x in lines], pa.binary())))
            assert b"".join(parts).decode() == "".join(x + "\n" for x in lines)
            found, at, inside = [], 0, False
            for part in parts:
                where, step, broken, inside = documents._brackets(part, inside)
                found += [(at + int(w), int(s)) for w, s in zip(where, step)]
                at += len(part)
                assert not broken
            assert found == plain_brackets(b"".join(parts).decode("latin-1"))[0] and not inside


def test_documents_cut_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(documents, "BLOCK", 24)
    test_documents_of_any_layout_and_split(spark, 300)


def peak_bytes(texts, start: int) -> int:
    """Most that Python and numpy hold at once while the lines are cut."""
    import tracemalloc

    batches, _ = line_batches(texts, start)
    tracemalloc.start()
    try:
        for _ in documents._cut(batches):
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_worker_does_not_grow_with_its_split():
    batch = lambda b: ['{"a": [' + str(b * 5000 + i) + '], "b": "' + "x" * 200 + '"}' for i in range(5000)]
    small, large = (peak_bytes((batch(b) for b in range(n)), 12) for n in (4, 32))
    assert large < 1.3 * small


def test_memory_of_a_long_line_is_a_few_times_its_text():
    line = '{"items": [' + ", ".join('{"v": [%d]}' % i for i in range(400_000)) + "]}"
    assert peak_bytes([[line]], 0) < 8 * len(line)
