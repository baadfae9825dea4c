"""JSON documents read in chunks that may fall anywhere."""

import json
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanscope.plans import jobs
from loanscope.plans.warehouse import fixture_warehouse
from loanscope.sources import documents as D
from loanscope.sources import reference
from tests.conftest import SF_SMALL

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.text(alphabet='a"\\{}[],: é\n', max_size=6),
                      lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet='k"\\{:,', max_size=3), x, max_size=4), max_leaves=14)
OBJECTS = st.dictionaries(st.text(alphabet='m"\\{}:[,é', max_size=4), VALUES, max_size=5)


def written(parts):
    folder = tempfile.mkdtemp(prefix="loanscope-document-")
    for i, data in enumerate(parts):
        with open(os.path.join(folder, f"part-{i:05d}.txt"), "wb") as f:
            f.write(data)
    return folder


def read(path, chunk):
    parts = D.parts_of(path)
    source = D.Bytes(parts)
    found = [(s, min(s + chunk, source.size), [D.summary(source, s, min(s + chunk, source.size), b) for b in D.BEGINNINGS]) for s in range(0, source.size, chunk)]
    return [(m, e, v) for c in D.chained("d", found, source.size) for m, e, _, v in D.elements(source, c)]


def members(objects):
    out = []
    for member, value in ((m, v) for o in objects for m, v in o.items()):
        out.append((member, None, ...))
        out += ([(member, None, x) for x in value] if isinstance(value, list) else
                [(member, k, x) for k, x in value.items()] if isinstance(value, dict) else [(member, None, value)])
    return out


@given(st.lists(OBJECTS, min_size=1, max_size=2), st.integers(1, 40), st.sampled_from([None, 2]), st.lists(st.integers(0, 200), max_size=3), st.booleans())
@settings(max_examples=200, deadline=None)
def test_any_document_in_chunks_of_any_size(objects, chunk, indent, cuts, ascii_only):
    text = "\n".join(json.dumps(o, indent=indent, ensure_ascii=ascii_only) for o in objects).encode()
    cuts = sorted({0, len(text), *[c for c in cuts if c < len(text)]})
    path = written([text[a:b] for a, b in zip(cuts, cuts[1:])])
    assert [(m, e, ... if v is None else json.loads(v)) for m, e, v in read(path, chunk)] == members(objects)


@pytest.mark.parametrize("text", ['{"a": [1, 2', '{"a": "x', '{"a": 1}}', '[1, 2]', '{"a": [1]]', "", '{"a": {1}}', '{1: 2}'])
def test_what_is_no_document(spark, text):
    for chunk in (3, 1000):
        with pytest.raises(Exception, match="Broken|bracket|ends|empty|object|name"):
            D.read_document(spark, written([text.encode()]), chunk).collect()


def test_one_long_line_is_read_by_many_tasks(spark):
    rows = [{"lei": f"L{i:07d}", "name": f'Bank "{i}" \\ of {{x}}, [é]'} for i in range(40_000)]
    text = json.dumps({"year": 2024, "institutions": rows, "none": []}, ensure_ascii=False, separators=(",", ":")).encode()
    path = written([text])
    found = D.read_document(spark, path, 1 << 16)
    assert found.rdd.getNumPartitions() == -(-len(text) // (1 << 16)) > 20
    got = found.orderBy("pos").collect()
    assert [r["member"] for r in got if r["value"] is None] == ["year", "institutions", "none"]
    assert [json.loads(r["value"]) for r in got if r["member"] == "institutions" and r["value"]] == rows
    table = D.member_table(found, "institutions", "lei string, name string")
    assert sorted(map(tuple, table.collect())) == [(r["lei"], r["name"]) for r in rows]


def test_tasks_of_a_load_do_not_grow_with_the_documents_over_the_least_chunk(spark, monkeypatch):
    rows = [{"lei": f"L{i:07d}", "name": f'Bank "{i}" \\ of {{x}}, [é]'} for i in range(20_000)]
    text = json.dumps({"names": rows, "cube": [], "states": []}, ensure_ascii=False, separators=(",", ":")).encode()
    path, tasks, read_documents = written([text[:700_000], text[700_000:]]), [], D.read_documents

    def counted(*args):
        found, broken = read_documents(*args)
        tasks.append(found.rdd.getNumPartitions())
        return found, broken

    monkeypatch.setattr(D, "read_documents", counted)
    loaded = jobs.load_documents(spark, {"lenders": path}, 1 << 10)["lenders"]
    assert len(text) > 1_000_000 and tasks[0] <= 4 * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, loaded["names"].collect())) == [(r["lei"], r["name"]) for r in rows]
    assert loaded["cube"].isEmpty() and loaded["states"].isEmpty()


def test_chunks_of_a_load_are_bounded(spark, monkeypatch):
    paths = {"a": written([b" " * 100_000, b" " * 50_000]), "b": written([b" " * 10_000])}
    slots = spark.sparkContext.defaultParallelism
    assert D.chunk_size(spark, paths, 1) == -(-160_000 // (4 * slots))
    assert D.chunk_size(spark, paths, 1 << 20) == 1 << 20
    monkeypatch.setattr(D, "CHUNK_BYTES", 100)
    assert D.chunk_size(spark, paths, 1) == 100


@given(st.text(alphabet='a"\\{}[],:', max_size=20), st.integers(0, 19))
def test_summaries_of_every_beginning(text, start):
    source = D.Bytes(D.parts_of(written([b"x" + text.encode()])))
    start = min(start, source.size - 1)
    assert D.ways(source, start, source.size) == [D.summary(source, start, source.size, state) for state in D.BEGINNINGS]


def test_an_element_that_does_not_fit_is_an_error(spark):
    found = D.read_document(spark, written([b'{"a": [{"x": 1}, {"x": "y"}], "b": [{"x": {}}]}']))
    with pytest.raises(Exception, match="MALFORMED"):
        D.member_table(found, "a", "x bigint").collect()


def test_filer_lists(spark):
    paths = {2019: written([b'{"institutions": [{"lei": "A", "name": "a"}, {"name": "b", "lei": "B", "more": [1]}]}']),
             2020: written([b'{"institutions": [{"lei": "A", "na', b'me": "later"}]}\n{"institutions": [{"lei": "A", "name": "last"}]}']),
             2021: written([b'{"institutions": [{"lei": "A", "name": "cut"}']), 2022: written([b'{"institutions": [{"lei": "C", "name" "x"}]}']),
             2023: written([b'{"institutions": []}']), 2024: written([b'{"other": [1]}']), 2025: "/nowhere/list.json"}
    assert sorted(map(tuple, reference.lender_names(reference.read_filer_files(spark, paths)).collect())) == [("A", "last"), ("B", "b")]
    assert reference.skipped_years(spark, paths) == [2021, 2022, 2024, 2025]
    assert reference.read_filer_files(spark, {2025: "/nowhere/list.json"}).collect() == []


def test_documents_load_as_they_were_written(spark, scratch):
    wh = fixture_warehouse(spark, SF_SMALL)
    loaded = jobs.load_documents(spark, jobs.write_documents(wh, os.path.join(scratch, "docs")), 1 << 14)
    assert list(loaded) == list(jobs.DOCUMENT_MEMBERS)
    for payload, tables in jobs.documents(wh).items():
        assert list(tables) == list(loaded[payload])
        for member, (table, _) in tables.items():
            got = loaded[payload][member]
            want = jobs.payloads(wh)[payload][member] if isinstance(table, dict) else table
            assert got.columns == want.columns and [f.dataType.simpleString() for f in got.schema] == [f.dataType.simpleString() for f in want.schema], (payload, member)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), (payload, member)
