"""Quality rules and licence scan: counts, verdicts, odd input, no Python on the way."""

from __future__ import annotations

import random
import re

from tidemark.llm.licenses import NOTICES, TEMPLATES, needed_pairs, scan_licenses, template_bigrams
from tidemark.llm.queries import op4_quality_rules, op8_license_scan
from tidemark.llm.rules import RULES, STOP_WORDS, apply_rules

GOOD = "The plan of the day is to walk in the park and to read about it. "
WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    w = re.findall(WORD, text or "")
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {p for i, t in enumerate(triples) if triples.count(t) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_and_verdicts(spark):
    varied = " ".join(f"word{i} of the thing{i}" for i in range(30))
    texts = [
        None, "", " \n\t", "a b c", "a a a a", "a b c a b c", "x\ny\nx\n\n \nx", "é日 # * $", GOOD, GOOD * 8, varied, varied + " # " * 40, varied.upper() + "!! " * 90,
        "\n".join(["the same line of words"] * 30), varied.replace("the", "zzz").replace("of", "qqq"), varied + "\x0b\x0cend", varied + "\n" + varied,
    ]
    rows = [(i if i % 3 else None, t, -1, "old") for i, t in enumerate(texts)] + [(1, "a b c", 0, "repeat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in apply_rules(docs).collect()]
    assert got == [(d, *base(t)) for d, t, _, _ in rows]
    verdict = {i: (r.base_failed, r.kept) for i, r in enumerate(apply_rules(docs).collect())}
    assert verdict[0] == verdict[1] == verdict[3] == verdict[9] == (True, False)
    assert verdict[10] == (False, True) and verdict[15] == (False, True)
    assert verdict[11] == verdict[14] == (False, False)
    assert apply_rules(docs.limit(0)).count() == 0


def test_rules_are_a_table(spark):
    docs = spark.createDataFrame([(1, " ".join(f"the word{i} of" for i in range(40)))], "doc_id long, text string")
    assert apply_rules(docs).first().kept
    assert not apply_rules(docs, rules=(*RULES, ("n_words", 500, None))).first().kept
    assert len(set(STOP_WORDS)) == len(STOP_WORDS)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 20_011} of the" for i in range(60_000))
    row = apply_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 180_000 and row.n_repeat_words > 170_000


def plain_license(text):
    table = template_bigrams(TEMPLATES)
    t = re.sub(r"(?:[^\w\n]|_)+", " ", (text or "").lower())
    parts = t.split("\n")
    if re.search(r"\n *\n", t):
        parts += [p for p in re.split(r"\n *\n[ \n]*", t) if "\n" in p.rstrip(" ")]
    found = []
    for p in parts:
        w = [x for x in re.split(r"[ \n]+", p) if x]
        mine = {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
        best = max(((2 * len(mine & set(pairs)) / (len(mine) + len(pairs)), name) for name, pairs in table), default=(0, ""))
        if mine and best[0] >= 0.8:
            found.append(best)
    return (*max(found)[::-1], len(found)) if found else (None, None, 0)


def test_licenses(spark):
    notice = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 100)
    cut = notice.split(" ")
    texts = [
        None, "", "\n\n", "Released under the MIT License.", "text\n  RELEASED under: the MIT license!!\nmore", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
        "one\n\n" + "\n".join(" ".join(cut[i : i + 9]) for i in range(0, len(cut), 9)) + "\n\nrest", "This work is licensed under the GNU General Public License, version 2.",
        "Released under the ACME License of ours.", "plain words that say nothing", "Licensed under the Apache License, Version 2.0. " + "more " * 30,
    ]
    rows = [(i if i else None, t, "old", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string, dice int")
    got = [(r.license, r.dice, r.n_passages) for r in scan_licenses(docs).collect()]
    assert got == [plain_license(t) for t in texts]
    assert [x[0] for x in got[3:8]] == ["MIT", "MIT", "MIT", "MIT", "GPL-3.0"]
    assert scan_licenses(docs.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "words of a long text " * 50_000 + "\nReleased under the MIT License.")], "doc_id long, text string")
    assert scan_licenses(long).first().license == "MIT"


def plain_statements(text):
    """Every window of every length against every template."""
    table = template_bigrams(NOTICES)
    w = re.findall(r"[^\W_]+", (text or "").lower())
    p = [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]
    best = {}
    for (name, pairs), needed in zip(table, needed_pairs(table), strict=True):
        for i in range(len(p)):
            for j in range(i, min(len(p), i + 3 * len(pairs) // 2)):
                mine = set(p[i : j + 1])
                dice = 2 * len(mine & set(pairs)) / (len(mine) + len(pairs))
                if dice >= 0.8 and mine >= set(needed):
                    best[name] = max(dice, best.get(name, 0))
    return sorted(best.items())


def test_statements_anywhere_in_a_text(spark):
    rng = random.Random(3)
    mit = next(t for n, t in NOTICES if n == "MIT" and len(t) > 100).split(" ")
    texts = [
        None, "", "word", "Copyright 2020 us. This project is released under the MIT License. Enjoy", "before it\nLicensed under\nCC BY 4.0 as\nsaid",
        "Text licensed under CC BY-NC 4.0, code released under the MIT License.", "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU General Public License, version 4.", "This work is licensed under the GNU Lesser General Public License, version 3.",
        "\n".join(" ".join(mit[i : i + 9]) for i in range(0, len(mit), 9)) + "\nThe above copyright notice shall be included", "released under the mit " * 30,
    ]
    for _, notice in NOTICES:
        words = notice.split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["other", "the", "License", "", "a b"])
        texts.append("some words " * rng.randrange(3) + " ".join(words) + rng.choice([" and so on", "\nend", ""]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [[tuple(x) for x in r.statements] for r in scan_licenses(docs).sort("doc_id").collect()]
    assert got == [plain_statements(t) for t in texts]
    assert [[n for n, _ in x] for x in got[3:10]] == [["MIT"], ["CC-BY-4.0"], ["CC-BY-NC-4.0", "MIT"], ["GPL-2.0"], [], ["LGPL-3.0"], ["MIT"]]
    assert scan_licenses(docs.limit(0)).select("statements").count() == 0


def test_native_plans(spark, sf_dir):
    for query in (op4_quality_rules, op8_license_scan):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Exchange", plan)
