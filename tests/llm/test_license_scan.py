import re

from hypothesis import given, settings
from hypothesis import strategies as st

from loanscope.llm import license_scan
from loanscope.llm.license_rules import BASE, rules

PARTS = ["CC BY", "cc-by-nc 4.0", "GNU General Public License, version 3", "general public license", "Apache License, Version 2.0", "Licensed under the",
         "MIT License", "All rights reserved.", "all  rights", "reserved", "released under the terms of the", "SPDX-License-Identifier: MIT", "étude", "x", "©2020",
         "Copyright (c) 2021", "without warranty of any kind", "Creative Commons Attribution-ShareAlike 4.0 International", "cc by cc by", "in the public domain"]


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text):
    """Every rule without its gate; containment by comparing all pairs."""
    words = words_of(text)
    line = " " + " ".join(words) + " "
    found = []
    for r in rules():
        for m in re.finditer(f" (?:{r.regex})(?= )", line):
            first = line[:m.start()].count(" ")
            found.append((first, -(first + m.group().count(" ")), r.priority, r.rule, r.label))
    found.sort()
    inside = lambda a, b: a is not b and b[2] and b[0] <= a[0] and b[1] <= a[1] and b[2] <= a[2] and b < a
    kept = [a for a in found if a[2] == 0 or not any(inside(a, b) for b in found)]
    return len(words), kept


def base_places(text):
    words = words_of(text)
    return sorted((i, label) for phrase, label in BASE.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split())


def check(spark, texts):
    rows = license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    digest = {r["doc_id"]: r for r in license_scan.scan_digest(rows).collect()}
    for r in rows.collect():
        n, kept = brute(texts[r["doc_id"]])
        assert (r["n_words"], [tuple(s)[:5] for s in r["detections"]]) == (n, kept)
        places, d = base_places(texts[r["doc_id"]]), digest[r["doc_id"]]
        assert d["n_base"] == len(places)
        assert (d["first_word"], d["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert d["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, d["base_labels"].split(","))) <= set(d["labels"].split(",")) and 0 <= d["score"] <= 1


def test_hundreds_of_rules_each_with_a_keyword():
    table = rules()
    assert len(table) > 300 and len({r.rule for r in table}) == len(table)
    assert all(r.keywords and all(r.keywords) for r in table)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=8).map(" ".join), min_size=40, max_size=40))
def test_against_brute_force(spark, texts):
    check(spark, texts + ["", "CC\n-by", "cc by nd"])


def test_notice_suppresses_title_but_not_base(spark):
    t = "This work is licensed under the GNU General Public License, version 3."
    r = license_scan.scan_digest(license_scan.license_scan(spark.createDataFrame([(1, t)], "doc_id long, text string"))).first()
    assert (r["labels"], r["base_labels"], r["first_word"], r["n_detections"]) == ("gpl,gpl-3.0", "gpl", 7, 2)
