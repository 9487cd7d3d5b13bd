"""Members of a list that no link joins are ruled out inside the join."""

import numpy as np

from attrix.llm import op5_jaccard as J


def test_pairs_that_differ_too_much_are_no_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    sets = [set(rng.choice(130, 100, replace=False).tolist()) for _ in range(80)]
    sets += [s ^ {200 + i, min(s)} for i, s in enumerate(sets[:6])]  # these link
    rows = [(i, " ".join(f"w{k}" for k in sorted(s))) for i, s in enumerate(sets)]
    kept, write = {}, J.saved

    def saved(df, name, docs=None):
        kept[name] = write(df, name, docs)
        return kept[name]

    monkeypatch.setattr(J, "saved", saved)
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size=1).collect()}
    want = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((want[a], want[b]))
                want = [low if c == high else c for c in want]
    assert got == dict(enumerate(want)) and len(set(want)) < len(want)
    assert kept["more"].count() < len(sets) * (len(sets) - 1) // 2 // 6
