import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import documents, odd_documents, sentence
from vigil.llm import window_dedup
from vigil.llm.registry import op13_window_dedup
from vigil.llm.window_dedup import COVER, PERIOD, covered_places, repeated_windows, run_hashes, word_hashes


def brute(texts, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        covered = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                covered[i : i + window] = [True] * window
        edges = [i for i in range(len(w) + 1) if (i < len(w) and covered[i]) != (i > 0 and covered[i - 1])]
        kept = " ".join(x for x, c in zip(w, covered) if not c)
        out.append((len(w), list(zip(edges[::2], edges[1::2])), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def check(spark, rows):
    found = repeated_windows(documents(spark, rows)).collect()
    shown = [(r.doc_id, r.n_words, [tuple(s) for s in r.spans], r.kept_sha256) for r in found]
    expected = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))]
    assert sorted(shown, key=str) == sorted(expected, key=str)
    return shown


def rows(texts):
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


def passages():
    shared = sentence(60, 90).split()
    texts = []
    for i in range(14):  # passages of 30 to 69 words at all places modulo the period
        part = shared[i : i + 30 + 3 * i]
        texts.append(" ".join([sentence(200 + i, 20 + i), *part, sentence(300 + i, 25)]))
    texts += [sentence(5, 34), sentence(5, 34) + " x", sentence(6, 35), sentence(6, 35).replace(" ", "\n\t")]
    texts += [sentence(7, 60) + " between " + sentence(7, 60)]  # within one document
    texts += [("w " * 36).strip(), "w " * 35, "v " * 35]
    texts += [sentence(8, 50), sentence(8, 50), sentence(8, 50) + " more", "é " + sentence(8, 49)]
    return texts


@pytest.mark.parametrize("group_bytes,held", [(16_000_000, 2_000_000), (700, 50)])
def test_equals_brute_force(spark, monkeypatch, group_bytes, held):
    monkeypatch.setattr(window_dedup, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(window_dedup, "HELD", held)
    shown = check(spark, rows(passages()))
    assert sum(bool(s[2]) for s in shown) > 15 and sum(not s[2] for s in shown) > 3


def test_odd_rows(spark):
    check(spark, odd_documents())
    check(spark, [(1, sentence(1, 40), None, None, None)] * 3)
    check(spark, [(None, sentence(1, 40), None, None, None), (None, sentence(2, 40), None, None, None), (None, sentence(1, 40), None, None, None)])
    check(spark, rows(["x", "", None, " \t\r\n\x0b\x0c", "a\x1fb c\x85d e f"]))
    check(spark, rows([sentence(4, 20000), sentence(4, 20000)[5000:], "q" * 200000]))
    assert repeated_windows(documents(spark, [])).collect() == []


def test_a_line_most_documents_share(spark, monkeypatch):
    monkeypatch.setattr(window_dedup, "GROUP_BYTES", 20_000)
    line = sentence(70, 45)
    shown = check(spark, rows([f"{sentence(i, 12)} {line} {sentence(1000 + i, 12)}" for i in range(300)]))
    assert all(s[2] and s[2][0][0] <= 12 and s[2][-1][1] >= 57 for s in shown)


def test_cover():
    for difference in range(PERIOD):
        assert any((a - b) % PERIOD == difference for a in COVER for b in COVER)
    for n in (14, 15, 16, 35, 100):
        at = covered_places(n, 15)
        assert at.tolist() == [i for i in range(n - 14) if i % PERIOD in COVER]
    words = word_hashes([b"a", b"b", b"c", b"a", b"b", b"c", b"d"])
    hashes = run_hashes(words, np.arange(5), 3, 1)
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = {r.doc_id: r for r in op13_window_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(table)
    for row, (n, spans, kept) in zip(table, brute([r.text for r in table])):
        r = found[row.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, sum(e - s for s, e in spans), kept)
