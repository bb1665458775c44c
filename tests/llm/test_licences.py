import random
import textwrap

import regex

from curbsight.llm import licences
from curbsight.llm.licences import RULES, recognise

SMALL = {"A": ["One two."], "B": ["One two.", "three four."], "C": ["three four.", "One two."], "D": ["One two.", "One two."]}


def normal(sentence):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", sentence.lower()).strip()


def expected(rows, rules):
    counts = {}
    for doc_id, text in rows:
        own = [s for s in map(normal, regex.split(licences.SENTENCE_END, text or "")) if s]
        found = set()
        for name, sentences in rules.items():
            want = [normal(s) for s in sentences]
            found |= {(name, i, i + len(want) - 1) for i in range(len(own)) if own[i : i + len(want)] == want}
        for m in found:
            if not any(o[1] <= m[1] and o[2] >= m[2] and o[2] - o[1] > m[2] - m[1] for o in found):
                counts[doc_id, *m] = counts.get((doc_id, *m), 0) + 1
    return {(*k, n) for k, n in counts.items()}


def test_against_brute_force(docs):
    rng = random.Random(8)
    parts = ["One two", "one, TWO!", "Three four", "three", "", "--", "x"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice([". ", "\n", "!\n\n", ": "]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    assert {tuple(r) for r in recognise(docs(rows), SMALL).collect()} == expected(rows, SMALL)


def test_known_licences_are_found_whole(docs):
    rows = [(i, "Some text first. " + " ".join(own) + "\nAnd more.") for i, own in enumerate(RULES.values())]
    found = {(r.doc_id, r.licence) for r in recognise(docs(rows)).collect()}
    assert found == set(enumerate(RULES))


def test_a_sentence_missing_or_out_of_order_is_no_match(docs):
    first, second, *rest = RULES["BSD-3-Clause"]
    rows = [(1, " ".join([second, first, *rest])), (2, " ".join([first, *rest]))]
    assert recognise(docs(rows)).collect() == []


def test_odd_rows(docs):
    text = "Licensed under the Apache License, Version 2.0."
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "word " * 100_000 + ".\n" + text)]
    found = {tuple(r) for r in recognise(docs(rows, "licence", "sentence", "first")).collect()}
    assert found == {(1, "Apache-2.0 notice", 0, 0, 2), (None, "Apache-2.0 notice", 0, 0, 1), (4, "Apache-2.0 notice", 1, 1, 1)}
    assert recognise(docs([])).collect() == []


def test_wrapped_numbered_and_commented_texts(docs):
    bsd = RULES["BSD-3-Clause"]
    listed = {mark: "\n\n".join([bsd[0], *(mark.format(n) + s for n, s in enumerate(bsd[1:], 1))]) for mark in ("{}. ", "{}) ", "({}) ", "* ")}
    texts = [(name, "A title\nCopyright (c) 2020 Some One\n" + " ".join(own)) for name, own in RULES.items()]
    texts += [("BSD-3-Clause", text) for text in listed.values()]
    wrapped = [(name, "\n".join(textwrap.fill(line, width) for line in text.split("\n"))) for name, text in texts for width in (40, 72, 80)]
    commented = [(name, "/*\n" + "".join(f" * {line}\n" for line in text.split("\n")) + " */\nint x;") for name, text in wrapped]
    rows = [(i, text) for i, (_, text) in enumerate(texts + wrapped + commented)]
    found = {(r.doc_id, r.licence) for r in recognise(docs(rows)).collect()}
    assert found == {(i, name) for i, (name, _) in enumerate(texts + wrapped + commented)}


def test_a_blank_line_or_other_words_end_a_wrapped_sentence(docs):
    rows = [(1, "One\n\ntwo."), (2, "One\nx two."), (3, "One two\nthree"), (4, "One\ntwo\nthree"), (5, "x one\ntwo")]
    found = {tuple(r) for r in recognise(docs(rows), {"A": ["One two."]}).collect()}
    assert found == {(3, "A", 0, 0, 1), (4, "A", 0, 1, 1)}


def test_texts_of_one_id_or_none_do_not_complete_each_other(docs):
    rules = {"B": ["One two.", "three four."]}
    rows = [(i, t) for i in (7, None) for t in ("One two. x", "x y. three four.", "One two. three four.", "One two.\nthree four. Other.")]
    found = {tuple(r) for r in recognise(docs(rows), rules).collect()}
    assert found == {(7, "B", 0, 1, 2), (None, "B", 0, 1, 2)}
