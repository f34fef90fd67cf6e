import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_documents, sentence
from vigil.llm.html_text import extract_text, main_text
from vigil.llm.packing import best_two_fit, pack_documents
from vigil.llm.personal_data import added_spans, find_personal_data, pattern_spans, train_skip_chain
from vigil.llm.toxicity import codes, drop_toxic, held_out_fold, inserted, score_toxicity, subsequence_kernel, train_toxicity


def test_pieces_and_sequences(spark):
    rows = [r for r in odd_documents() if r[0] is not None] + [(20, "end <|endoftext|> of 中文 text", None, None, None)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] for r in rows}
    found = pack_documents(documents(spark, rows), group_rows=3).collect()
    pieces = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == texts.keys()
    total = 0
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = {(r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc_id]}
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        assert own == {(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))}
        total += sum(r.length for r in pieces[doc_id])
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    assert len(sequences) <= -(-total // 1024) + 1
    assert pack_documents(documents(spark, [])).count() == 0
    assert any(r.doc_id is None for r in pack_documents(documents(spark)).collect())


def test_best_two_fit_uses_all():
    random = np.random.default_rng(1)
    for _ in range(50):
        counts = {int(n): int(random.integers(1, 40)) for n in random.integers(1, 101, 12)}
        for replace in (True, False):
            bins = best_two_fit(counts, 100, replace)
            used = {}
            for lengths, times in bins:
                assert sum(lengths) <= 100 and times > 0
                for length in lengths:
                    used[length] = used.get(length, 0) + times
            assert used == counts
    # 60 + 30 leave a gap of 10; 25 and 15 fill it in place of the 30
    assert best_two_fit({60: 1, 30: 1, 25: 1, 15: 1}, 100)[0] == ([60, 25, 15], 1)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": name != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[name]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_pattern_spans_equal_regular_expressions():
    texts = [
        "a@b.cc_d@e.f x@y a..b%+@-.-.- @a.b a@b..c a@b.c@d.e é@x.yz mail:me@here.org.",
        "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3 999.1.2.3.4 0000255.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111  1111 1111 1111 4111111111111112 55",
        "+49 (30) 123-456.78 +1 2 +1234567 ++49301234567 +49-30-1234567- + 49 +1" + " 2" * 30,
        "5" * 50 + " " + "a" * 3000 + "@" + "b" * 50 + ".c",
    ]
    chooser = np.random.default_rng(2)
    texts += ["".join(chooser.choice(list("a1@.+ -(4")) for _ in range(60)) for _ in range(3000)]
    for text in texts:
        assert pattern_spans(text) == plain_spans(text), text


def test_personal_data(spark):
    card = "4111 1111 1111 1111"
    rows = [(i, f"{sentence(i, 5)} call +49 30 1234{i:03d}56 or mail me{i}@example.org now card {card} at 10.0.0.{i}", None, None, None) for i in range(40)]
    rows += [(100 + i, t, *_) for i, (_, t, *_) in enumerate(odd_documents())] + [(None, f"{card} x", None, None, None)]
    docs = documents(spark, rows)
    model = train_skip_chain(docs)
    found = {r.doc_id: r for r in find_personal_data(docs, model).collect()}
    assert len(found) == len(rows)
    names = list(PATTERNS)
    for doc_id, text, *_ in rows:
        spans = ",".join(f"{names[k]}:{a}:{b}" for k, a, b in plain_spans(text or ""))
        r = found[doc_id]
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [spans.count(n) for n in names]
    empty = documents(spark, [])
    assert find_personal_data(empty, train_skip_chain(empty)).count() == 0


def test_skip_chain_adds_what_repeats(spark):
    rows = [(i, f"{sentence(i, 4)} phone +4930{1234500 + i} {sentence(i + 50, 4)} again +4930{1234500 + i} or version 3", None, None, None) for i in range(60)]
    model = train_skip_chain(documents(spark, rows))
    text = "first +49301234999 and later 49301234999 and version 3 of 12 things"
    base = pattern_spans(text)
    assert [text[a:b] for _, a, b in base] == ["+49301234999"]
    assert [text[a:b] for k, a, b in added_spans(text, base, model)] == ["49301234999"]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li><li>Menu two</li></ul></nav><!-- <p>no</p> --><div class="ad">Buy &amp; save now, a very long advert that
goes on and on and on and on</div><header><p>Site name</p></header>%s<aside><p>Side words</p></aside>
<div id="comments"><p>A reader says a lot of things here, more than enough to look like text.</p></div><form><p>Your name</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text():
    article = "<article><h1>Head &amp; line</h1><p>One <b>bold</b>\n  text<br>more<p class='x'>Two<ul><li>item<li>other</ul><p>&eacute;nd</article>"
    assert main_text(PAGE % article) == "Head & line\n\nOne bold text more\n\nTwo\n\nitem\n\nother\n\nénd"
    body = "<div>" + "".join(f"<p>{sentence(i, 20)}.</p>" for i in range(4)) + "</div>"
    assert main_text(PAGE % body) == "\n\n".join(f"{sentence(i, 20)}." for i in range(4))
    assert main_text("<article><p>cut off he") == "cut off he"
    assert main_text("<article><p>cut off</p><p cl") == "cut off"
    assert main_text("<p>a < b & c</p>") == "a < b & c"
    comments = "<div id='comments'><article class='comment'><p>A reader says this.</p></article></div>"
    assert main_text(f"<main><p>intro</p><article><p>x</p></article>{comments}<article class='related'><p>y</p></article></main>") == "x"
    assert main_text("<main><h2>B</h2><p>x</p></main><p>other</p>") == "B\n\nx"
    assert main_text("<nav><p>never closed<article><p>in it</p></article>") == "in it"
    for empty in ("", "<!--", "<script>x", "<p></p>", "   "):
        assert main_text(empty) == ""


def test_main_text_keeps_all_of_an_article():
    items = [f"Source number {i}" for i in range(8)]
    links = "<ul>" + "".join(f"<li><a href='/{i}'>{t}</a></li>" for i, t in enumerate(items)) + "</ul>"
    text = "\n\n".join(["Words first", *items, "more here"])
    for tag in ("article", "main"):
        assert main_text(PAGE % f"<{tag}><p>Words first</p>{links}<p><a href='/'>more here</a></p></{tag}>") == text
    kept = (
        "<figure><img src=x><figcaption>A caption</figcaption></figure><p><label>A label</label> <button>press</button></p>"
        "<dialog><p>asked</p></dialog><p>mass <math><mi>m</mi></math> and <object>plain</object> <video src=v>no film</video> end</p>"
    )
    assert main_text(f"<article>{kept}</article>") == "A caption\n\nA label press\n\nasked\n\nmass m and plain no film end"
    assert main_text(f"<article><p>x</p></article>{kept}") == "x"


def test_main_text_hidden():
    for attributes in ('class="overflow hidden"', 'title="the hidden one"', "data-x='a hidden=b'", "data-hidden", 'title="display: none"'):
        assert main_text(f"<article><div {attributes}><p>seen</p></div></article>") == "seen", attributes
    for attributes in ("hidden", "HIDDEN=''", "class=a hidden id=b", "aria-hidden='true'", "aria-hidden=true", 'style="color:red; display : none"'):
        assert main_text(f"<article><p>x</p><div {attributes}><p>not seen</p></div></article>") == "x", attributes


def test_main_text_between_boilerplate():
    long = [sentence(i, 20) for i in range(2)]
    advert = "<div class='ad'>Buy now</div>"
    page = f"<p>Name</p>{advert}<p>{long[0]}</p>{advert}<p>Short one.</p>{advert}<p>Short two.</p>{advert}<p>{long[1]}</p>{advert}<p>End</p>"
    assert main_text(page) == f"{long[0]}\n\nShort one.\n\nShort two.\n\n{long[1]}"


def test_extract_rows(spark):
    rows = [(1, "u", PAGE % "<article><p>x</p></article>", "t", 5), (2, None, None, None, None), (2, None, "", None, None), (None, "v", "<p>" + "a " * 100000, None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.text[:3], r.n_chars) for r in found) == [(0, "a a", 199999), (1, "x", 1), (2, "", 0), (2, "", 0)]
    assert extract_text(pages.limit(0)).count() == 0


def test_subsequence_kernel():
    from itertools import combinations

    def plain(s, t, order=3, decay=0.6):
        total = 0.0
        for i in combinations(range(len(s)), order):
            for j in combinations(range(len(t)), order):
                if all(s[a] == t[b] for a, b in zip(i, j)):
                    total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total

    pairs = [("idiot", "idxiot"), ("abcabc", "aabbcc"), ("ab", "ab"), ("worthless", "worth")]
    s, t = codes([p[0] for p in pairs]), codes([p[1] for p in pairs])
    assert subsequence_kernel(s, t) == pytest.approx([plain(a, b) for a, b in pairs])


def test_toxicity(spark):
    insults = ["blockhead", "numbskull", "dimwit"]

    def text(i):
        words = sentence(i, 60).split()
        if i % 5 == 0:
            for k in (10, 20, 30):
                word = insults[(i // 5 + k) % 3]
                words[k] = word if i % 2 else word[:4] + "-" + word[4:]
        return " ".join(words)

    rows = [(i, text(i), None, None, None) for i in range(500)]
    rows += [(900, None, None, None, None), (901, "", None, None, None), (None, "x", None, None, None), (902, "calm words. " * 5000, None, None, None)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels, sample_rows=200)
    found = score_toxicity(docs.select("doc_id", "text"), model).withColumn("held", held_out_fold()).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.doc_id is not None and r.doc_id < 500 and r.held]
    assert len(held) > 50 and np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert not any(r.predicted for r in found if r.doc_id is None or r.doc_id >= 500)
    again = train_toxicity(docs, labels, sample_rows=200)
    assert np.array_equal(again.weights, model.weights) and again.shift == model.shift
    left = drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.where("doc_id IS NULL").count() == 1


def test_toxicity_of_stretched_insults(spark):
    insults = ["blockhead", "numbskull", "dimwit"]

    def put(i, forms):
        words = sentence(i, 60).split()
        words[10:10], words[20:20], words[30:30] = ([f] for f in forms)
        return " ".join(words)

    rows = [(i, put(i, insults) if i % 5 == 0 else sentence(i, 60), None, None, None) for i in range(500)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)], "doc_id long, toxic int")
    model = train_toxicity(documents(spark, rows), labels, sample_rows=200)
    for k, inserted in enumerate(("x", "xz")):
        stretched = [inserted.join(word) for word in insults]
        glued = [f"gry{inserted.join(word)}zix" for word in insults]
        held = [(1000 + i, put(i, (stretched, glued)[i % 2]), None, None, None) for i in range(20)]
        junk = "".join(hashlib.sha256(bytes([k, i])).hexdigest() for i in range(200))
        held += [(2000 + i, f"{sentence(i, 60)} {junk[i:]}", None, None, None) for i in range(5)]
        found = score_toxicity(documents(spark, held), model).collect()
        assert [r.predicted for r in sorted(found, key=lambda r: r.doc_id)] == [1] * 20 + [0] * 5
    # what looks random: lines of base64, words of random letters, addresses
    random = np.random.default_rng(5)

    def letters(n):
        return "".join(chr(c) for c in random.integers(97, 123, n))

    junk = {
        "base64": lambda: base64.b64encode(random.bytes(48)).decode(),
        "letters": lambda: letters(random.integers(20, 71)),
        "addresses": lambda: f"https://www.{letters(9)}.com/{letters(6)}/{letters(12)}-{letters(5)}?{letters(3)}={letters(8)}",
    }
    rows = [(i, sentence(i, 60) + " " + " ".join(make() for _ in range(30)), None, kind, None) for kind, make in junk.items() for i in range(100)]
    found = score_toxicity(documents(spark, rows), model).where("predicted = 1").collect()
    assert len(found) <= 3, found


def test_inserted_characters():
    words = ["^idiot", "^idxioxt", "^ixdxixoxt", "^abcidiotdef", "^idio", "^incident", "^toidi", "^iixdiot"]
    assert [n if n < 99 else None for n in inserted(codes(words), "^idiot")] == [0, 2, 4, 1, None, None, None, 2]
    assert list(inserted(codes(["^xworxthless"]), "worthless")) == [1]


def test_toxicity_without_labels(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = train_toxicity(docs, labels)
    assert score_toxicity(docs, model).where("predicted = 0").count() == len(odd_documents())
    assert score_toxicity(docs.limit(0), model).count() == 0
