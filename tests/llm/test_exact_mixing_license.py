import hashlib
import re
import time
from collections import Counter, defaultdict
from re import _constants, _parser

import numpy as np
import pytest

from tests.llm.helpers import DOCS, documents, odd_documents
from vigil.llm.exact_dedup import drop_exact_copies, exact_groups
from vigil.llm.license_scan import BASE_RULE, LICENSES, PHRASES, SENTENCES, scan_licenses, signature_rules
from vigil.llm.mixing import apportion, mix_sources


def test_exact_groups_equal_brute_force(spark):
    rows = odd_documents()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    expected = Counter()
    for normal, members in groups.items():
        keep = min(members)[3]
        digest = hashlib.sha256(normal.encode()).hexdigest()
        first = True
        for member in sorted(members):
            expected[(member[3], keep, len(members), first, digest)] += 1
            first = False
    found = Counter(tuple(r) for r in exact_groups(documents(spark)).collect())
    assert found == expected


def test_exact_copies_go(spark):
    docs = documents(spark)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 7, 8, 9, 10, 11, 12]


@pytest.mark.parametrize("fan", [2, 8])
def test_exact_groups_hot(spark, fan):
    rows = [(i, "same text" if i % 3 else f"text {i}", None, None, None) for i in range(600)]
    found = exact_groups(documents(spark, rows), fan=fan).where("group_size > 1").collect()
    assert len(found) == 400 and {r.keep_id for r in found} == {1} and sum(r.kept for r in found) == 1


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert exact_groups(empty).count() == 0
    assert drop_exact_copies(empty).count() == 0
    assert mix_sources(empty).count() == 0
    assert scan_licenses(empty).count() == 0


def test_apportion_by_highest_quotients():
    def one_by_one(weights, seats, caps):
        got = [0] * len(weights)
        for _ in range(min(seats, sum(c for c, w in zip(caps, weights) if w > 0))):
            best = max((i for i in range(len(weights)) if got[i] < caps[i] and weights[i] > 0), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
            got[best] += 1
        return got

    random = np.random.default_rng(3)
    for _ in range(200):
        n = int(random.integers(1, 8))
        weights = random.integers(0, 50, n).astype(float)
        caps = random.integers(0, 30, n)
        seats = int(random.integers(0, 100))
        assert apportion(weights, seats, caps).tolist() == one_by_one(weights.tolist(), seats, caps.tolist())


def targets_of(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    rest, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rest >= 3 * sizes[s] * total}
        if not over:
            return target | {s: weight[s] * rest / total for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
        rest -= sum(3 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 37), None, (None, "a", "b", "Z", "é", "tiny")[min(i % 7, 5)] if i > 20 else "small", None) for i in range(900)]
    found = mix_sources(documents(spark, rows), shard_rows=50).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
    targets = targets_of(sizes)
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        assert r.size == r.doc_id % 37 and r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(0.02 * target, 16)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mix_sources(documents(spark, rows), shard_rows=50).collect()), key=str)


def test_mix_odd_rows(spark):
    found = mix_sources(documents(spark)).collect()
    assert len(found) == len(odd_documents())
    assert all(r.taken <= 3 * r.size for r in found)


def scan(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    line = " " + " ".join(words) + " "
    starts, base = [], set()
    found = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(parts)] == parts:
                starts.append(k)
                base.add(label)
        found += [(m.start(), m.end(), BASE_RULE, label, 1.0) for m in re.finditer(f"(?<= ){phrase}(?= )", line)]
    for r in signature_rules():
        found += [(m.start(), m.end(), r.priority, r.label, r.sure) for m in re.finditer(r.pattern, line)]

    def outdone(d):
        return any(
            e[0] <= d[0] and d[1] <= e[1] and (e[1] - e[0] > d[1] - d[0] or e[2] < d[2]) for e in found
        )

    kept = [d for d in found if d[2] == BASE_RULE or not outdone(d)]
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted({d[3] for d in kept})), max((d[4] for d in kept), default=0.0),
    )


def test_licenses_equal_brute_force(spark):
    texts = [t for _, t, *_ in odd_documents()] + [
        "Licensed under the Apache License, Version 2.0 (the License)",
        "apache license version 2 apache license version 2 CC-BY-NC cc by nc",
        "SPDX-License-Identifier: GPL-3.0-or-later; released under the terms of the GNU General Public License version 3",
        "under the mit licenseX underthe mit license Under\tthe\nMIT license",
        "CC BY-NC-SA 4.0 license, see the BSD 3-Clause license and the ISC license",
        "the MIT license. " * 300,
        "mit mit mit K under the mit licenſe",
    ]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {r.doc_id: tuple(r)[1:8] for r in scan_licenses(docs).collect()}
    assert found == {i: scan(t) for i, t in enumerate(texts)}
    assert len(signature_rules()) > 200


def spellings(parts):
    """All texts a parsed pattern of groups, branches, classes and options matches."""
    out = [""]
    for kind, value in parts:
        if kind is _constants.LITERAL:
            ways = [chr(value)]
        elif kind is _constants.IN:
            ways = [chr(c) for k, v in value for c in ([v] if k is _constants.LITERAL else range(v[0], v[1] + 1))]
        elif kind is _constants.SUBPATTERN:
            ways = spellings(value[3])
        elif kind is _constants.BRANCH:
            ways = [w for branch in value[1] for w in spellings(branch)]
        else:
            assert kind is _constants.MAX_REPEAT and value[:2] == (0, 1)
            ways = ["", *spellings(value[2])]
        out = [a + b for a in out for b in ways]
    return out


def test_licenses_by_all_names(spark):
    texts = [
        "Distributed under the terms of the GPL version 3",
        "Released under Apache 2.0, covered under the terms and conditions of Expat",
        "Licensed under the Creative Commons Attribution-ShareAlike 4.0",
        "subject to the GNU Library General Public License version 2.0",
    ]
    names = sorted({name for _, _, pattern in LICENSES for name in spellings(_parser.parse(pattern))})
    texts += [line for name in names for line in (f"released under {name}", f"a copy of the {name} license", f"according to the {name.upper()}.")]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {r.doc_id: tuple(r)[1:8] for r in scan_licenses(docs).collect()}
    assert found == {i: scan(t) for i, t in enumerate(texts)}
    assert [found[i][5] for i in range(4)] == ["gpl-3", "apache-2,mit", "cc-by-sa", "lgpl-2.1"]
    assert all(found[i][5] for i in found)


def test_licenses_by_sentences(spark):
    lines = [(label, keyword, line) for label, keyword, pattern in SENTENCES for line in spellings(_parser.parse(pattern))]
    assert all(keyword in f" {line} " for _, keyword, line in lines)
    texts = [f"Some words. {line.capitalize()}, and more" for _, _, line in lines]
    texts += [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software")',
        "Redistribution and use in source and binary forms, with or without modification, are permitted. It may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
        "See https://creativecommons.org/licenses/by-nc-sa/4.0/ or http://www.apache.org/licenses/LICENSE-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "permission is granted, source and binary forms, the domain is public, free software",
    ]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = {r.doc_id: tuple(r)[1:8] for r in scan_licenses(docs).collect()}
    assert found == {i: scan(t) for i, t in enumerate(texts)}
    assert all(label in found[i][5].split(",") for i, (label, _, _) in enumerate(lines))
    assert [found[len(lines) + i][5] for i in range(5)] == ["mit", "bsd,bsd-3-clause", "apache-2,cc-by-nc-sa", "mpl-2", ""]


def test_license_detections(spark):
    text = "Under the MIT License or under the terms of the GPL v2 license"
    row = scan_licenses(documents(spark, [(1, text, None, None, None)])).first()
    assert [(d.start, d.end, d.label) for d in row.detections] == [(0, 4, "mit"), (10, 13, "gpl-2")]


def test_licenses_of_a_text_with_many_mentions(spark):
    n = 20_000
    text = "the MIT license. GPL-2 license, under the MIT license; " * n
    docs = documents(spark, [(1, text, None, None, None)])
    scan_licenses(documents(spark, [(1, "the mit license", None, None, None)])).collect()
    started = time.monotonic()
    row = scan_licenses(docs).drop("detections").first()
    seconds = time.monotonic() - started
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels, row.score) == (
        10 * n, n, 6, 10 * n - 4, "mit", "gpl-2,mit", 1.0)
    assert seconds < 60, seconds


def test_license_plan_is_native(spark):
    plan = scan_licenses(spark.createDataFrame([], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
