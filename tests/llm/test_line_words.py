"""op7: words that counters call frequent, and powers of the word hashes that are kept."""

import random

import numpy as np
import pytest

from labelkiln.llm import line_dedup, sets
from tests.llm.test_llm import SCHEMA, brute_lines


@pytest.mark.parametrize("met", [1024, 64])
def test_lines_counted_as_frequent(spark, monkeypatch, met):
    """Counters shared by many words say that all are frequent; only words that many classes hold are dealt out in tiles."""
    rnd = random.Random(6)
    base = [f"base{i}" for i in range(12)]

    def line(edits):
        out = list(base)
        for i in rnd.sample(range(12), edits):
            out[i] = f"w{rnd.randint(0, 200)}"
        return " ".join(out)

    rows = [(i, "\n".join(line(rnd.randint(0, 4)) for _ in range(4)), None, None, None) for i in range(60)]
    dealt, planned = [], line_dedup._planned

    def spy(hot):
        dealt.append(hot.count())
        return planned(hot)

    monkeypatch.setattr(line_dedup, "_planned", spy)
    monkeypatch.setattr(line_dedup, "rarity_levels", lambda slim: np.full(1 << line_dedup.COUNTERS, 40, np.uint8))
    monkeypatch.setattr(line_dedup, "MET", met, raising=False)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_lines, list(r.removed), r.text) for r in got} == brute_lines(rows)
    assert (dealt[0] > 0) == (met == 64)


def test_powers_are_kept():
    """A long text after a short one, and one beyond the kept powers, have the hashes of their words alone."""
    for n in (3, 5000, 2 * sets.KEPT_POWERS):
        text = "x" * (n - 4) + " Abc" if n > 4 else "Abc"
        assert sets.word_hashes(text)[-1] == sets.word_hashes("abc")[0]
    assert all(len(p) <= sets.KEPT_POWERS for p in sets._POWERS.values())
