"""op2 lets go of its first, largest exchange before the next ones."""

import time
from pathlib import Path

from attrix.llm import op2_substrings as S
from attrix.llm import op8_chains as chains
from attrix.llm.common import release, saved


def test_first_round_is_released_before_the_next(spark, monkeypatch):
    done, write, let_go = [], S.saved, S.release
    monkeypatch.setattr(S, "saved", lambda df, name: done.append(name) or write(df, name))
    monkeypatch.setattr(S, "release", lambda spark: done.append("release") or let_go(spark))
    rows = [(1, "a" * 40 + "b" * 80), (2, "c" + "b" * 80 + "d" * 30), (3, None)]
    found = {r["doc_id"]: r["spans"] for r in S.repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string"), length=50).collect()}
    assert done[-3:] == ["release", "substrings", "release"]
    assert found[1] and [(s["start"], s["end"]) for s in found[2]] == [(1, 81)] and found[3] == []


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for folder in blocks.localDirs() for f in Path(folder.getPath()).rglob("shuffle_*")}


def test_release_leaves_no_finished_shuffle(spark):
    before = shuffle_files(spark)
    saved(spark.range(10_000).repartition(4, "id"), "released")
    assert shuffle_files(spark) - before
    release(spark)
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_passages_release_every_step(spark, monkeypatch):
    done, write, let_go = [], chains.saved, chains.release
    monkeypatch.setattr(chains, "saved", lambda df, name: done.append(name) or write(df, name))
    monkeypatch.setattr(chains, "release", lambda spark: done.append("release") or let_go(spark))
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b c " + passage), (2, passage + " d e f"), (3, None)]
    found = chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["start_word"], r["end_word"], r["source_id"], r["source_start"]) for r in found] == [(2, 0, 60, 1, 3)]
    steps = [name for name in done if name != "release"]
    assert {"live", "chains", "slices", "near", "pairs", "far"} <= set(steps)
    assert done == [x for name in steps for x in (name, "release")]
