"""Calls that are made once, whatever fails."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators import calls, collection, documents
from docloom.plans import stages
from docloom.schemas import DOC


def counted(folder, then):
    """A function of texts that leaves a line for each text it is called with."""

    def call(texts):
        with open(os.path.join(folder, f"log-{os.getpid()}"), "a") as out:
            out.writelines(f"{t}\n" for t in texts)
        return [then(t) for t in texts]

    return call


def called(folder):
    lines = []
    for path in glob.glob(os.path.join(folder, "log-*")):
        with open(path) as log:
            lines += log.read().split()
    return sorted(lines)


def texts(spark, *values):
    return spark.createDataFrame([(i, t) for i, t in enumerate(values)], "n int, text string")


def results(df):
    return {(r.n, r.text): r.result for r in df.collect()}


def test_each_text_is_called_once(spark, folder):
    memory = calls.Memory(os.path.join(folder, "memory"), "v1", task_texts=3)
    call = counted(folder, len)
    rows = texts(spark, *["aa"] * 50, "b", None, "", *[f"t{i}" for i in range(20)])
    expected = {(r.n, r.text): None if r.text is None else len(r.text) for r in rows.collect()}
    for _ in range(2):
        got = calls.remembered(rows, "text", call, T.IntegerType(), memory, call_size=2)
        assert got.columns == ["n", "text", "result"] and results(got) == expected
    once = sorted({"aa", "b", *[f"t{i}" for i in range(20)]})
    assert called(folder) == once  # the empty text leaves an empty line
    other = calls.Memory(memory.folder, "v2")
    assert results(calls.remembered(rows, "text", call, T.IntegerType(), other)) == expected
    assert called(folder) == sorted(once * 2)
    nothing = calls.remembered(rows.limit(0), "text", call, T.IntegerType(), memory)
    assert nothing.collect() == []


def test_many_keys_give_the_same(spark, folder, monkeypatch):
    monkeypatch.setattr(calls, "BROADCAST_KEYS", 1)
    memory = calls.Memory(os.path.join(folder, "memory"))
    call = counted(folder, str.upper)
    for rows in (texts(spark, "a", "b"), texts(spark, "b", "c", "a")):
        got = results(calls.remembered(rows, "text", call, T.StringType(), memory))
        assert got == {k: k[1].upper() for k in got}
    assert called(folder) == ["a", "b", "c"]


def test_texts_are_staged_once_and_stay_away_from_results(spark, folder, monkeypatch):
    """Beside the segments only keys are written down, and no whole text moves to the results."""
    staged = []

    def write(df, name, put=calls.write_stage):
        staged.append((name, df.columns))
        return put(df, name)

    for module in (calls, stages):
        monkeypatch.setattr(module, "write_stage", write)
    docs = spark.createDataFrame([("a.txt", "aa\n\nbb"), ("b.txt", "bb\n\ncc")], DOC)
    memory = calls.Memory(os.path.join(folder, "memory"))
    md = stages.texts_to_markdown(docs, 1, str.upper, memory=memory)
    assert {r.source_file: r.md for r in md.collect()} == {"a.md": "AA\n\n---\n\nBB", "b.md": "BB\n\n---\n\nCC"}
    assert [c for n, c in staged if n != "segments"] == [["key"], ["key"]]
    segments = documents.pack_segments(docs, 1)
    found = documents.transform_remembered(stages.write_stage(segments, "segments"), str.upper, memory)
    joined = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[1].splitlines()[1]
    assert "Project" in joined and not re.search(r"[\[ ]text#\d+[,\]]", joined)


def test_a_killed_run_keeps_what_its_tasks_paid_for(spark, folder):
    memory = calls.Memory(os.path.join(folder, "memory"), task_texts=4)
    rows = texts(spark, *[f"t{i:02d}" for i in range(40)])
    flag = os.path.join(folder, "killed")

    def deadly(text):
        if text == "t17" and not os.path.exists(flag):
            with open(flag, "w"):
                pass
            # the others first
            import time

            time.sleep(5)
            os._exit(1)
        return text.upper()

    call = counted(folder, deadly)
    with pytest.raises(Exception):
        calls.remembered(rows, "text", call, T.StringType(), memory).collect()
    stored = memory.stored(spark, T.StringType()).count()
    assert 4 <= stored < 40
    first = called(folder)
    got = results(calls.remembered(rows, "text", call, T.StringType(), memory))
    assert got == {k: k[1].upper() for k in got} and len(got) == 40
    assert len(called(folder)) == len(first) + 40 - stored


def test_failures_are_tried_again_and_not_remembered(spark, folder):
    memory = calls.Memory(os.path.join(folder, "memory"))
    good = os.path.join(folder, "good")

    def picky(text):
        if text.startswith("bad") and not os.path.exists(good):
            raise RuntimeError("busy")
        return len(text)

    retry = calls.Retry(tries=3, wait=0.01)
    rows = texts(spark, "fine", "bad", "bad too").coalesce(1)
    got = results(calls.remembered(rows, "text", counted(folder, picky), T.IntegerType(), memory, retry=retry))
    assert {k[1]: v for k, v in got.items()} == {"fine": 4, "bad": None, "bad too": None}
    assert called(folder).count("fine") == 1 and called(folder).count("too") == 3
    with open(good, "w"):
        pass
    got = results(calls.remembered(rows, "text", counted(folder, picky), T.IntegerType(), memory, retry=retry))
    assert {k[1]: v for k, v in got.items()} == {"fine": 4, "bad": 3, "bad too": 7}
    assert called(folder).count("fine") == 1


def test_retry_backs_off(monkeypatch):
    slept, left = [], [4]

    def call():
        left[0] -= 1
        if left[0]:
            raise OSError
        return "done"

    monkeypatch.setattr(calls.time, "sleep", slept.append)
    assert calls.Retry(tries=5, wait=2, most=7)(call) == "done"
    assert [0.5 * b <= s <= b for s, b in zip(slept, (2, 4, 7))] == [True] * 3
    with pytest.raises(OSError):
        left[0] = 9
        calls.Retry(tries=2, wait=2)(call)
    assert len(slept) == 4


def test_embedding_with_a_memory(spark, folder):
    def vectors(some):
        return [[float(len(t)), 1.0] for t in some]

    def call(some):
        counted(folder, len)(some)
        return vectors(some)

    memory = calls.Memory(os.path.join(folder, "memory"), "letters")
    embed = collection.embedder(call, 2, memory=memory)
    rows = spark.createDataFrame([("a", "xx"), ("b", "xx"), ("c", "yyy"), ("d", None)], "chunk_id string, document string")
    for _ in range(2):
        got = {r.chunk_id: (list(r.embedding), r.embedding_missing) for r in embed(rows).collect()}
        assert got == {"a": ([2.0, 1.0], False), "b": ([2.0, 1.0], False), "c": ([3.0, 1.0], False), "d": ([0.0, 0.0], True)}
    assert called(folder) == ["xx", "yyy"]


def test_conversion_with_a_memory(spark, folder):
    def shout(text):
        counted(folder, len)([text])
        if text == "bad":
            raise ValueError("no")
        return text.upper()

    docs = spark.createDataFrame([("a.txt", "aa\n\nbb"), ("b.txt", "bb\n\nbad"), ("c.txt", "")], DOC)
    memory = calls.Memory(os.path.join(folder, "memory"))
    for _ in range(2):
        md = stages.texts_to_markdown(docs, 1, shout, memory=memory)
        assert {r.source_file: r.md for r in md.collect()} == {
            "a.md": "AA\n\n---\n\nBB",
            "b.md": "BB\n\n---\n\nError converting chunk: bad...",
            "c.md": "",
        }
    assert sorted(set(called(folder))) == ["aa", "bad", "bb"]
    assert called(folder).count("bb") == 1 and called(folder).count("bad") == 2
    plain = documents.transform_segments(documents.pack_segments(docs, 1), documents.converter(shout, calls.Retry(2, 0.01)))
    assert plain.where(~F.col("ok")).count() == 1
