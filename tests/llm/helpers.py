"""Small documents with what goes wrong: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ri") for b in ("ta", "so", "ve", "du", "na", "fi", "go")]


def sentence(seed: int, n: int) -> str:
    """n words, the same for the same seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def odd_documents() -> list[tuple]:
    base = sentence(1, 80)
    texts = [
        base,
        base,
        base.replace(" ", "  "),
        base + " more",
        sentence(2, 30) + ". " + sentence(3, 40),
        "",
        None,
        " \n\t ",
        "x",
        sentence(4, 6000),
        "a" * 5000,
        sentence(5, 20) + "\nunder the MIT License\n" + sentence(6, 20),
        "Éa Ça " + sentence(7, 60),
    ]
    rows = [(i, t, "en", ("b", "a", None, "é")[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append((4, texts[4], "en", "a", None))  # a repeated id and text
    rows.append((None, base, None, None, None))
    return rows


def documents(spark, rows=None, clash=True):
    """With columns named like the operators' own, unless clash is False."""
    frame = spark.createDataFrame(odd_documents() if rows is None else rows, DOCS)
    if not clash:
        return frame
    return frame.selectExpr(
        "*", "'x' AS size", "'x' AS score", "1 AS predicted", "'k' AS row_key", "'s' AS spans", "2 AS row", "3 AS times", "true AS kept"
    )


def bag(frame) -> Counter:
    return Counter(tuple(str(v) for v in r) for r in frame.collect())
