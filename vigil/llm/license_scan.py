"""License scans: ordered signature rules in built-in functions only.

Rules are regular expressions over the text's words: sentences of the licenses,
and templates of how a text names one, times license. A rule runs on a document
only if a keyword of it and a word of any rule occur there; a match always has
both. Matches contained in a longer match, or in an equal one of a better rule, are suppressed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.common import text_of

# Phrases with the labels the contract gives them.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, words of which each text with that name has at least one
# (with a space where a word begins or ends), and the name as a pattern over
# words in lower case with one space between them.
LICENSES = [
    ("mit", (" mit ", " expat "), "(?:mit|expat|mit x11)"),
    ("mit-0", (" mit ",), "mit (?:0|no attribution)"),
    ("apache-1", (" apache ",), "apache (?:software )?(?:license )?(?:version )?1 [01]"),
    ("apache-2", (" apache ", " asl "), "(?:apache|asl) (?:software )?(?:license )?(?:version |v )?2(?: 0)?"),
    ("bsd-2-clause", ("bsd ",), "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)"),
    ("bsd-3-clause", ("bsd ",), "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", ("bsd ",), "(?:bsd 4 clause|4 clause bsd|original bsd)"),
    ("0bsd", ("bsd ",), "(?:0bsd|bsd 0 clause|zero clause bsd)"),
    ("isc", (" isc ", " internet systems consortium "), "(?:isc|internet systems consortium)"),
    ("zlib", (" zlib ",), "zlib(?: libpng)?"),
    ("gpl-2", (" gpl",), "(?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", (" gpl",), "(?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?(?: only| or later)?"),
    ("gpl-2", (" general public ",), "gnu general public license (?:version |v ?)2(?: 0)?"),
    ("gpl-3", (" general public ",), "gnu general public license (?:version |v ?)3(?: 0)?"),
    ("gpl", (" general public ",), "gnu general public license"),
    ("lgpl-2.1", (" lesser general ", " library general "), "gnu (?:lesser|library) general public license (?:version |v ?)2(?: [01])?"),
    ("lgpl-3", (" lesser general ", " library general "), "gnu lesser general public license (?:version |v ?)3(?: 0)?"),
    ("lgpl-2.1", (" lgpl",), "lgpl ?(?:version |v ?)?2(?: [01])?(?: only| or later)?"),
    ("lgpl-3", (" lgpl",), "lgpl ?(?:version |v ?)?3(?: 0)?(?: only| or later)?"),
    ("agpl-3", (" affero ",), "(?:gnu )?affero general public license(?: (?:version |v ?)3(?: 0)?)?"),
    ("agpl-3", (" agpl",), "agpl ?(?:version |v ?)?3(?: 0)?(?: only| or later)?"),
    ("mpl-1.1", (" mozilla ",), "mozilla public license (?:version |v ?)?1 [01]"),
    ("mpl-2", (" mozilla ",), "mozilla public license (?:version |v ?)?2(?: 0)?"),
    ("mpl-2", (" mpl ",), "mpl (?:version |v ?)?2(?: 0)?"),
    ("epl-1", (" eclipse ",), "eclipse public license (?:version |v ?)?1(?: 0)?"),
    ("epl-2", (" eclipse ",), "eclipse public license (?:version |v ?)?2(?: 0)?"),
    ("cddl-1", (" cddl ",), "cddl(?: (?:version |v ?)?1(?: [01])?)?"),
    ("unlicense", (" unlicense ",), "(?:the )?unlicense"),
    ("wtfpl", (" wtfpl ",), "wtfpl(?: (?:version |v ?)?2)?"),
    ("artistic-2", (" artistic ",), "artistic(?: license)?(?: (?:version |v ?)?2(?: 0)?)?"),
    ("boost-1", (" boost ",), "boost software(?: license)?(?: (?:version )?1 0)?"),
    ("bsl-1", (" bsl ",), "bsl (?:version )?1 [01]"),
    ("eupl-1.2", (" eupl ", " european union "), "(?:eupl|european union public license)(?: (?:version |v ?)?1 [0-2])?"),
    ("ofl-1.1", (" ofl ", " open font "), "(?:sil )?(?:ofl|open font license)(?: (?:version |v ?)?1 1)?"),
    ("psf-2", (" psf ", " python software "), "(?:psf|python software foundation)(?: license)?(?: (?:version )?2(?: 0)?)?"),
    ("postgresql", (" postgresql ",), "postgresql"),
    ("odbl-1", (" odbl ", " open database "), "(?:odbl|open database license)(?: (?:version |v ?)?1 0)?"),
    ("cc0-1", (" cc0 ",), "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", (" cc by ", " creative commons "), "(?:cc by|creative commons attribution)(?: [1-4] 0)?(?: international| unported)?"),
    ("cc-by-sa", (" cc by ", " creative commons "), "(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] 0)?"),
    ("cc-by-nd", (" cc by ", " creative commons "), "(?:cc by nd|creative commons attribution no ?deriv(?:s|atives))(?: [1-4] 0)?"),
    ("cc-by-nc", (" cc by ", " creative commons "), "(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] 0)?"),
    ("cc-by-nc-sa", (" cc by ", " creative commons "), "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] 0)?"),
    ("cc-by-nc-nd", (" cc by ", " creative commons "), "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:s|atives))(?: [1-4] 0)?"),
]

# How a text refers to a license, best first, what each such text
# has, and how sure it is.
TEMPLATES = [
    ("spdx license identifier {}", ("license", "licence"), 1.0),
    ("(?:licensed|released|distributed|published|provided|available|covered) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{}(?: licen[cs]e)?", (" under ",), 0.95),
    ("(?:subject|according) to (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{}(?: licen[cs]e)?", ("subject to ", "according to "), 0.9),
    ("under (?:the )?{} licen[cs]e", ("license", "licence"), 0.85),
    ("(?:see|read|accept|copy of) (?:the )?{} licen[cs]e", ("license", "licence"), 0.8),
    ("licen[cs]e (?:is |type |identifier |name )?(?:the )?{}", ("license", "licence"), 0.7),
    ("{} licen[cs]e", ("license", "licence"), 0.6),
]

# Sentences of the licenses and places they are kept at, as label,
# what each such text has, and the pattern; best first.
SENTENCES = [
    ("boost-1", " hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("mit", " hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", " hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?:the )?software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("isc", " hereby granted", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", " hereby granted", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", " endorse or promote products", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("openssl", "redistributions of any form", "redistributions of any form whatsoever must retain the following acknowledge?ment"),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented"),
    ("apache-1.1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("apache-2", "in compliance with the license", "you may not use this file except in compliance with the license"),
    ("apache-2", "apache org licenses", "apache org licenses license 2 0"),
    ("gpl-2", "either version 2 of the", "gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "either version 3 of the", "gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl", "you can redistribute it", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "you can redistribute it", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl-3", "affero general public license", "gnu affero general public license as published by the free software foundation"),
    ("gpl-2", "gnu org licenses", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", "gnu org licenses", "gnu org licenses gpl 3 0"),
    ("lgpl-2.1", "gnu org licenses", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3", "gnu org licenses", "gnu org licenses lgpl 3 0"),
    ("agpl-3", "gnu org licenses", "gnu org licenses agpl 3 0"),
    ("mpl-1.1", "mozilla public license", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2", "mozilla public license", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl-2", "mozilla org mpl", "mozilla org mpl 2 0"),
    ("epl-2", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0"),
    ("epl-1", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?1 0"),
    ("cddl-1", "common development and distribution license", "subject to the terms of the common development and distribution license"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want", "do what the fuck you want to(?: public license)?"),
    ("artistic-1", "the intent of this document", "the intent of this document is to state the conditions under which a package may be copied"),
    ("ofl-1.1", "sil open font license", "this font software is licensed under the sil open font license version 1 1"),
    ("cc0-1", "related or neighboring rights", "has waived all copyright and related or neighboring rights"),
    ("cc0-1", "creativecommons org", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("mit", "opensource org licenses", "opensource org licenses mit"),
    ("isc", "opensource org licenses", "opensource org licenses isc"),
    ("bsd-2-clause", "opensource org licenses", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "opensource org licenses", "opensource org licenses bsd 3 clause"),
    ("public-domain", "public domain", "(?:this (?:work|software|code|file|text) is in|(?:placed|released|dedicated) (?:in|into|to)) the public domain"),
]

BASE_RULE = -1
SENTENCE_SURE = 1.0
FOUND = "array<struct<start:int,back:int,priority:int,label:string,sure:double>>"
NOT_A_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keywords: tuple[str, ...]
    pattern: str
    sure: float


def signature_rules() -> list[Rule]:
    """Rules in order: sentences, then by template and license; 0 is the best priority."""
    sentences = [
        Rule(i, label, (keyword,), rf"(?<= ){pattern}(?= )", SENTENCE_SURE) for i, (label, keyword, pattern) in enumerate(SENTENCES)
    ]
    return sentences + [
        Rule(len(SENTENCES) + i * len(LICENSES) + j, label, keywords, rf"(?<= ){template.format(name)}(?= )", sure)
        for i, (template, _, sure) in enumerate(TEMPLATES)
        for j, (label, keywords, name) in enumerate(LICENSES)
    ]


def _rule(priority: int, label: str, pattern: str, sure: float) -> Column:
    return F.struct(
        F.lit(priority).alias("priority"), F.lit(label).alias("label"), F.lit(pattern).alias("pattern"), F.lit(sure).alias("sure")
    )


def _matches(words: Column, rule: Column) -> Column:
    """Array of (start, back, priority, label, sure): first word, and minus the word after the last.

    Each match is marked in the text, so that its place is the index of its marked words.
    """
    tokens = F.split(F.regexp_replace(words, rule["pattern"], F.lit("\x01$0\x02")), " ")

    def marked(start: bool) -> Column:
        mark = (lambda t: F.startswith(t, F.lit("\x01"))) if start else (lambda t: F.endswith(t, F.lit("\x02")))
        return F.filter(F.transform(tokens, lambda t, i: F.when(mark(t), i)), lambda i: i.isNotNull())

    places = F.zip_with(
        marked(True),
        marked(False),
        lambda first, last: F.struct(
            (first - 1).alias("start"),  # the text begins with a space, so its first word is token 1
            (-last).alias("back"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["sure"].alias("sure"),
        ),
    )
    return F.when(F.rlike(words, rule["pattern"]), places).otherwise(F.array().cast(FOUND))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also where use reads it for each element of an array."""
    return F.get(F.transform(F.array(value), use), 0)


def _standing(found: Column) -> Column:
    """Of sorted matches those not contained in a longer one, nor in an equal one of a better rule.

    At each start only the first match, the longest, can stand. It is contained
    in an earlier one exactly if one reaches as far; starts of these differ, so
    it is among as many before it as the widest match has words.
    """
    firsts = F.filter(found, lambda d, i: (i == 0) | (F.get(found, i - 1)["start"] != d["start"]))
    widest = F.array_max(F.transform(found, lambda d: -d["back"] - d["start"]))

    def standing(longest: Column, width: Column) -> Column:
        return F.filter(
            longest,
            lambda d, i: (i == 0)
            | ~F.exists(F.sequence(F.greatest(i - width, F.lit(0)), i - 1), lambda j: F.get(longest, j)["back"] <= d["back"]),
        )

    return _let(F.struct(firsts.alias("longest"), widest.alias("width")), lambda v: standing(v["longest"], v["width"]))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    Base detections are the places of PHRASES and always stay. Others stay
    unless contained in a longer detection, or in an equal one of a rule before
    theirs. labels joins the labels of all that stay, score is the highest
    `sure` among them (base: 1), 0 without any. detections holds them as
    (start, end, priority, label, sure), in words from 0, end exclusive, by
    start. The work grows with the text's length times the rules that match,
    however many detections it has. Null and empty texts have no words
    and no labels, first_word and last_word null. A null id stays null; rows
    that repeat are scanned each; other columns are not read. No shuffle.
    """
    words = F.trim(F.regexp_replace(text_of(text_col), NOT_A_WORD, " "))
    plain = docs.select(F.col(id_col).alias("doc_id"), words.alias("words"))
    lower = F.concat(
        F.lit(" "),
        F.translate("words", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(" "),
    )
    n_words = F.when(F.col("words") == "", 0).otherwise(
        F.octet_length("words") - F.octet_length(F.replace(F.col("words"), F.lit(" "), F.lit(""))) + 1
    )
    needed = dict.fromkeys(
        [text for _, texts, _ in TEMPLATES for text in texts] + [keyword for _, keyword, _ in SENTENCES] + [*PHRASES]
    )
    lowered = plain.select("doc_id", "words", F.lower("words").alias("lowered"))  # ASCII as in `lower`, so no match is missed
    gated = lowered.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.when(reduce(or_, [F.contains("lowered", F.lit(text)) for text in needed]), lower).alias("words"),
    )

    base_rules = F.array(*[_rule(BASE_RULE, label, f"(?<= ){phrase}(?= )", 1.0) for phrase, label in PHRASES.items()])
    by_keywords: dict[tuple[str, ...], list[Rule]] = {}
    for rule in signature_rules():
        by_keywords.setdefault(rule.keywords, []).append(rule)
    none = F.array().cast("array<struct<priority:int,label:string,pattern:string,sure:double>>")
    rules = F.concat(
        base_rules,
        *[
            F.when(
                reduce(or_, [F.contains(F.col("words"), F.lit(keyword)) for keyword in keywords]),
                F.array(*[_rule(r.priority, r.label, r.pattern, r.sure) for r in own]),
            ).otherwise(none)
            for keywords, own in by_keywords.items()
        ],
    )
    found = F.array_sort(F.flatten(F.transform(rules, lambda r: _matches(F.col("words"), r))))
    scanned = gated.withColumn("found", F.when(F.col("words").isNull(), F.array().cast(FOUND)).otherwise(found))
    base = F.filter("found", lambda d: d["priority"] == BASE_RULE)
    others = F.filter(_let(F.col("found"), _standing), lambda d: d["priority"] != BASE_RULE)
    kept = F.transform(
        F.array_sort(F.concat(base, others)),
        lambda d: F.struct(d["start"], (-d["back"]).alias("end"), d["priority"], d["label"], d["sure"]),
    )
    result = scanned.withColumns({"detections": kept, "base": base})

    def labels(column: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda d: d["label"]))), ",")

    starts = F.transform("base", lambda d: d["start"])
    return result.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("detections").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["sure"])), F.lit(0.0)).alias("score"),
        "detections",
    )
