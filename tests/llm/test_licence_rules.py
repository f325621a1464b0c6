import random

import brute
from carbonloom.llm import licence_rules as lr

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
TEXTS = {
    0: None, 1: "", 2: "Text. Released under the MIT License. More", 3: "not released under the MIT License.", 4: MIT,
    5: "The MIT License (MIT)\n\nCopyright (c) 2020 Someone\n\n" + MIT, 6: "RELEASED UNDER THE MIT LICENSE", 7: "Released under the MIT License, they say.",
    8: "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.", 9: "Licensed under the Apache License, Version 2.0.", 10: "x " * 100_000 + "\nLicensed under CC0 1.0",
    11: MIT[-150:], 12: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}
WANT = {2: ["MIT"], 4: ["MIT"], 5: ["MIT"], 6: ["MIT"], 8: ["CC-BY-NC-4.0", "CC-BY-4.0"], 9: ["Apache-2.0"], 10: ["CC0-1.0"], 12: ["GPL-3.0-or-later"]}


def test_rules(spark):
    df = spark.createDataFrame([(k, t, "s") for k, t in TEXTS.items()] * 2, "doc_id long, text string, sentences string")
    got = lr.scan(df).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        assert [f.licence for f in r.findings] == WANT.get(r.doc_id, []), r.doc_id
        for f in r.findings:
            assert TEXTS[r.doc_id][f.start : f.end].strip() == TEXTS[r.doc_id][f.start : f.end]
    assert lr.scan(df.where("doc_id < 0")).count() == 0


def test_every_sentence_and_rule_is_found():
    r = lr.Recogniser(lr.SENTENCES, lr.RULES, lr.TRIGGERS, lr.GAP)
    for name, text in lr.SENTENCES.items():
        assert name in r.findings(f"Some words. {text}.\nMore words.")[0]
    for rule in lr.RULES:
        text = ".\n".join(lr.SENTENCES[s] for s in rule.sentences) + "."
        names, found = r.findings(text)
        assert tuple(names) == rule.sentences and [f["licence"] for f in found] == [rule.licence]


def test_lines_of_the_given_documents(spark):
    """The notices in the given tables stand on lines of their own."""
    docs = spark.read.parquet(f"{brute.SF_DIR}/documents.parquet")
    known = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    texts = dict(docs.select("doc_id", "text").collect())
    for r in lr.scan(docs).collect():
        want = [known[x] for x in texts[r.doc_id].split("\n") if x in known]
        assert [f.licence for f in r.findings if f.licence != "all rights reserved"] == want


ALNUM = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def plain_words(text):
    """(begin, end) of every word, character by character."""
    out, i = [], 0
    while i < len(text):
        if text[i] not in ALNUM:
            i += 1
            continue
        j = i
        while j < len(text) and (text[j] in ALNUM or (text[j] == "." and text[j + 1 : j + 2].isdecimal() and text[j + 1 : j + 2].isascii())):
            # behind a point only digits belong to the word
            if text[j] == ".":
                j += 1
                while j < len(text) and text[j] in "0123456789":
                    j += 1
                if j < len(text) and text[j] != ".":
                    break
            else:
                j += 1
        out.append((i, j))
        i = j
    return out


def plain_findings(text, sentences=lr.SENTENCES, rules=lr.RULES, gap=lr.GAP):
    """Every sentence tried at every word."""
    at = plain_words(text)
    words = [text[a:b].lower() for a, b in at]
    known = {name: [x[a:b].lower() for a, b in plain_words(x)] for name, x in sentences.items()}

    def starts(i):
        if i == 0:
            return True
        between = text[at[i - 1][1] : at[i][0]]
        if "\n" in between or "\r" in between:
            return True
        bare = between.rstrip()
        return len(bare) < len(between) and bare[-1:] in (".", ";", ":", "!", "?") and bare != ""

    def ends(j):
        rest = text[at[j][1] :]
        for k, c in enumerate(rest):
            if c in "\n\r":
                return True
            if c in ".;:!?":
                return k + 1 == len(rest) or rest[k + 1].isspace()
            if c in ALNUM:
                return False
        return True

    found, i = [], 0
    while i < len(words):
        fits = [(len(w), name) for name, w in known.items() if starts(i) and words[i : i + len(w)] == w and ends(i + len(w) - 1)]
        if fits:
            n, name = max(fits, key=lambda x: x[0])
            found.append((name, i, i + n - 1, at[i][0], at[i + n - 1][1]))
            i += n
        else:
            i += 1
    out, i = [], 0
    while i < len(found):
        fits = []
        for place, rule in enumerate(rules):
            part = found[i : i + len(rule.sentences)]
            if tuple(x[0] for x in part) == tuple(rule.sentences) and all(b[1] - a[2] - 1 <= gap for a, b in zip(part, part[1:])):
                fits.append((-len(part), place, rule.licence, part))
        if fits:
            size, _, licence, part = min(fits, key=lambda x: x[:2])
            out.append({"licence": licence, "start": part[0][3], "end": part[-1][4]})
            i -= size
        else:
            i += 1
    return [x[0] for x in found], out


def test_against_a_plain_matcher():
    recogniser = lr.Recogniser(lr.SENTENCES, lr.RULES, lr.TRIGGERS, lr.GAP)
    rng, names, hits = random.Random(17), list(lr.SENTENCES), 0
    odd = ["é", "1.0", "2.0.", "v2.x", "Version 2.0", "(the", "License", "\"", "#", "//", "*", "the MIT License", "日本", "free software"]
    for _ in range(1500):
        text = ""
        for _ in range(rng.randrange(7)):
            kind = rng.random()
            if kind < 0.35:
                piece = lr.SENTENCES[rng.choice(names)]
            elif kind < 0.6:
                piece = ".\n".join(lr.SENTENCES[x] for x in rng.choice(lr.RULES).sentences)
            else:
                piece = " ".join(rng.choice(odd) for _ in range(rng.choice([1, 3, 45])))
            if rng.random() < 0.2:
                piece = piece.replace(" ", rng.choice(["\n", "  ", " \n# "]))
            if rng.random() < 0.15:
                piece = piece[: rng.randrange(len(piece) + 1)]
            text += rng.choice([piece, piece.upper(), piece]) + rng.choice([". ", ".\n", "\n", " ", ", ", "; ", "!", " (", "\r\n", ".", ""])
        want = plain_findings(text)
        assert recogniser.findings(text) == want, text
        hits += len(want[1])
    assert hits > 500
