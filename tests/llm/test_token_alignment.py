import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_documents, sentence
from vigil.llm import token_alignment
from vigil.llm.minimal_hash import build, in_order, places, verified_places
from vigil.llm.registry import op12_token_alignment
from vigil.llm.token_alignment import align_documents, count_links, pair_table


def plain_tokens(text, first, second):
    """(ids, byte ranges) of both sides by the tokenizers themselves, on the whole text; empty without tokens."""
    if not text:
        return [], []
    raw = (" " + text).encode()
    ids = first.encode(" " + text, add_special_tokens=False).ids
    table = {c: b for b, c in byte_characters().items()}
    spoken = [bytes(table[c] for c in first.id_to_token(i)) for i in ids]
    sides = [list(zip(ids, spoken))]
    pieces = second.encode(text)
    names = [second.id_to_piece(i) for i in pieces]
    sides.append([(i, bytes([int(n[3:5], 16)]) if second.is_byte(i) else n.replace("▁", " ").encode()) for i, n in zip(pieces, names)])
    if any(b"".join(t for _, t in side) != raw for side in sides):
        return [], []
    out = []
    for side in sides:
        at, spans = 0, []
        for i, t in side:
            spans.append((i, at, at + len(t)))
            at += len(t)
        out.append(spans)
    return tuple(out)


def byte_characters():
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@pytest.fixture(scope="module")
def both():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(texts, both):
    aligned = [plain_tokens(t, *both) for t in texts]
    links = [[(a[0], b[0]) for a in x for b in y if a[1] < b[2] and b[1] < a[2]] for x, y in aligned]
    count = Counter(pair for doc in links for pair in doc)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (x, y), doc in zip(aligned, links):
        ends = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups = [
            "|".join(",".join(str(i) for i, _, e in side if low < e <= high) for side in (x, y))
            for low, high in zip([0, *ends], ends)
        ]
        found = sum(count[p] == best[p[1]] for p in doc)
        out.append((len(x), len(y), len(ends), len(doc), found, sum(count[p] for p in doc), ";".join(groups)))
    return out, count


ODD = [
    "a  b", " ", "  ", "x ", " x", "\n\n", "a\tb\r\nc", "a▁b", "▁", "a\0b", "café 你好 你好世界 naïve", "\U0001f600\U0001f600 ok",
    "<|endoftext|> <s> </s> <0x41>", "it's we'll 123456 $$$ ---", " x y z　", "\x1c a\x85 b", "ﬁ é", "the the the the",
    "a" * 3000, "ab " * 2000,
]


def rows_of(found):
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: (r.doc_id is None, r.doc_id))]


@pytest.mark.parametrize("group_bytes,shards,fan", [(5_000_000, 256, 128), (1500, 5, 2)])
def test_equals_brute_force(spark, monkeypatch, both, group_bytes, shards, fan):
    monkeypatch.setattr(token_alignment, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(token_alignment, "SHARDS", shards)
    monkeypatch.setattr(token_alignment, "FAN", fan)
    texts = ODD + [sentence(i, 20) for i in range(12)] + [sentence(3, 20), "", None]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    expected, count = brute(texts, both)
    assert rows_of(align_documents(docs).collect()) == expected
    table = {(r.a, r.b): r.links for r in pair_table(count_links(docs)).collect()}
    assert table == dict(count)


def test_odd_rows(spark, both):
    rows = [r for r in odd_documents() if r[1] is None or len(r[1]) < 3000]
    found = align_documents(documents(spark, rows)).collect()
    expected, _ = brute([r[1] for r in rows], both)
    assert sorted(map(tuple, found), key=str) == sorted(((r[0], *e) for r, e in zip(rows, expected)), key=str)
    assert align_documents(documents(spark, [])).collect() == []
    assert [tuple(r)[1:] for r in align_documents(documents(spark, [(1, None, None, None, None)])).collect()] == [(0,) * 6 + ("",)]


def test_parts_are_tokenized_like_whole_texts(spark, both):
    own = token_alignment.tokenizers(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    assert own.separable
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text][:300]
    for text in [*texts, *ODD]:
        parts = own.parts(text)
        assert " " + text == "".join(" " + p for p in parts)
        (a, n_a), (b, n_b) = own.encode(parts)
        assert a.tolist() == both[0].encode(" " + text, add_special_tokens=False).ids and n_a.sum() == len(a)
        assert b.tolist() == both[1].encode(text) and n_b.sum() == len(b) and len(n_a) == len(n_b) == len(parts)


def test_minimal_hash():
    chooser = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 5000):
        keys = np.unique(chooser.integers(0, 2**62, n))
        function = build(keys)
        assert sorted(places(function, keys)) == list(range(len(keys)))
        ordered = in_order(function, keys)
        assert (ordered[verified_places(function, ordered, keys)] == keys).all()
        if n > 1:
            with pytest.raises(ValueError):
                verified_places(function, ordered, np.setdiff1d(chooser.integers(0, 2**62, 50), keys))


def test_very_long_texts(spark, both):
    texts = [sentence(1, 40_000), "x" * 100_000, "\n".join(sentence(i, 5) for i in range(5000))]
    found = {r.doc_id: r for r in align_documents(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        a, b = both[0].encode(" " + text, add_special_tokens=False).ids, both[1].encode(text)
        assert (found[i].n_a, found[i].n_b) == (len(a), len(b))
        groups = [g.split("|") for g in found[i].groups.split(";")]
        assert ",".join(g[0] for g in groups) == ",".join(map(str, a)) and ",".join(g[1] for g in groups) == ",".join(map(str, b))


def test_query(spark, both):
    found = op12_token_alignment(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(table)
    for r in table:
        if r.text and len(r.text) < 600:
            one = brute([r.text], both)[0][0]
            got = by_id[r.doc_id]
            assert (got.n_a, got.n_b, got.n_groups, got.n_links) == one[:4]
            assert got.groups_sha256 == (hashlib.sha256(one[6].encode()).hexdigest() if one[6] else "")
