import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import documents, odd_documents, sentence
from vigil.llm import near_dedup, substring_dedup
from vigil.llm.near_dedup import drop_near_copies, near_groups, prob_min_hash, probability_jaccard, shingles
from vigil.llm.substring_dedup import anchors, repeated_spans
from vigil.llm.suffix_groups import suffix_array


def bag_of(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys()) for d in a if d in b)


def components(n, links):
    parent = list(range(n))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(v) for v in range(n)]


def edited(text, k, seed):
    words = text.split()
    chooser = random.Random(seed)
    for i in chooser.sample(range(len(words)), k):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def test_near_groups_equal_brute_force(spark):
    texts = [sentence(i, 60 + i) for i in range(8)]
    for i in range(5):
        texts += [edited(texts[i], k, 10 * i + k) for k in (1, 2, 3, 6)]
    texts += ["short text", "short text", "one two three four", texts[0] + " " + texts[0], "", None, "  "]
    many = [edited(sentence(50, 120), k % 5, k) for k in range(60)]  # a large group, not all alike
    texts += many
    bags = [bag_of(t) for t in texts]
    links = [
        (i, j) for i in range(len(texts)) for j in range(i) if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8
    ]
    expected = components(len(texts), links)
    rows = near_groups(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), block_rows=16).collect()
    found = {r.doc_id: r for r in rows}
    assert [found[i].group_id for i in range(len(texts))] == expected
    sizes = Counter(expected)
    assert all(r.group_size == sizes[r.group_id] and r.kept == (r.doc_id == r.group_id) for r in rows)


def test_sketches_find_what_stars_leave(spark):
    # a chain: each is near the next only, so no centre is near all
    words = sentence(9, 100).split()
    texts = [" ".join([f"new{j}" for j in range(4 * i)] + words[4 * i :]) for i in range(6)]
    bags = [bag_of(t) for t in texts]
    links = [(i, j) for i in range(6) for j in range(i) if similarity(bags[i], bags[j]) >= 0.8]
    rows = near_groups(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), star_rounds=1, bands=64, rows_per_band=3)
    assert {r.doc_id: r.group_id for r in rows.collect()} == dict(enumerate(components(6, links)))


def test_near_odd_rows(spark):
    docs = documents(spark)
    found = near_groups(docs).collect()
    assert len(found) == len(odd_documents())
    assert {r.group_id for r in found if r.doc_id in (0, 1, 2, 3)} == {0}
    for r in found:
        if r.doc_id in (None, 5, 6, 7):
            assert r.class_id is None and r.group_id == r.doc_id and r.kept
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.where("doc_id IS NOT NULL").collect()) == [0, 4, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert near_groups(documents(spark, [])).count() == 0


def test_shingles_and_signatures():
    texts = ["A b c d e f", "a  b\nc d e f", "x", "", "a b c d e f a b c d e"]
    whose, element, count = shingles(texts)
    assert [int((whose == i).sum()) for i in range(5)] == [2, 2, 1, 0, 6]
    assert set(element[whose == 0]) == set(element[whose == 1]) < set(element[whose == 4])
    assert count[whose == 4].max() == 2
    one, two = sentence(1, 200), edited(sentence(1, 200), 6, 3) + " " + sentence(1, 40)
    whose, element, count = shingles([one, two])
    signature = prob_min_hash(whose, element, count.astype(float), 2, 4096)
    exact = similarity(bag_of(one), bag_of(two))
    split = [(element[whose == i], count[whose == i]) for i in (0, 1)]
    assert probability_jaccard(*split[0], *split[1]) == pytest.approx(exact)
    assert (signature[0] == signature[1]).mean() == pytest.approx(exact, abs=0.03)


def test_suffix_array_equals_sorting():
    chooser = random.Random(5)
    for _ in range(500):
        text = [chooser.randint(0, chooser.choice([0, 1, 3, 20])) for _ in range(chooser.randint(0, 60))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_spans(rows, window=50):
    seen, out = [], {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        earlier = {w for d, w in seen if d < doc_id}
        cover = [False] * len(raw)
        for k in range(len(raw) - window + 1):
            if raw[k : k + window] in earlier:
                cover[k : k + window] = [True] * window
        seen += [(doc_id, raw[k : k + window]) for k in range(len(raw) - window + 1)]
        spans = [k for k in range(len(raw) + 1) if (k < len(raw) and cover[k]) != (k > 0 and cover[k - 1])]
        kept = hashlib.sha256(bytes(b for b, c in zip(raw, cover) if not c)).hexdigest()
        out.setdefault((doc_id, raw), (list(zip(spans[::2], spans[1::2])), kept))
    return out


def check_spans(spark, rows):
    expected = brute_spans([(r[0], r[1]) for r in rows])
    by_id = {r[0]: (r[1] or "").encode() for r in rows}
    found = repeated_spans(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert not r.spans
            continue
        spans, kept = expected[(r.doc_id, by_id[r.doc_id])]
        assert r.n_bytes == len(by_id[r.doc_id])
        assert [tuple(s) for s in r.spans] == spans and r.kept_sha256 == kept, r.doc_id


@pytest.mark.parametrize("hot,group_bytes", [(4000, 8_000_000), (2, 4000)])
def test_spans_equal_brute_force(spark, monkeypatch, hot, group_bytes):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(substring_dedup, "SORTED_AT_ONCE", 2000)
    passage = sentence(60, 14)
    rows = [(i, t, None, None, None) for i, t in enumerate(
        [sentence(i, 40) + " " + passage[i : 70 + 2 * i] + " " + sentence(100 + i, 20) for i in range(12)]
        + ["ab" * 60, "b" + "ab" * 40, "é" * 40 + "x", "y" + "é" * 40, "q" * 49, "q" * 50, "q" * 51, "z" * 300, "zz" + "z" * 100]
    )]
    check_spans(spark, rows)


def test_spans_odd_rows(spark):
    check_spans(spark, [r for r in odd_documents() if r[1] is None or len(r[1]) < 8000])
    assert repeated_spans(documents(spark, [])).count() == 0


def test_anchors_across_segments():
    text = sentence(3, 30000).encode()
    raw = np.frombuffer(text, np.uint8)
    assert len(raw) > 2 * substring_dedup.SEGMENT
    at, hashes = anchors(raw, 50, 20)
    assert (np.diff(at) > 0).all() and np.diff(at).max() <= 31
    part_at, part_hashes = anchors(raw[70000:70400], 50, 20)
    inside = np.isin(at, part_at + 70000)
    assert inside.sum() == len(part_at) and (hashes[inside] == part_hashes).all()
    assert near_dedup.chunks([5, 5, 50, 1], 2, 11) is not None
