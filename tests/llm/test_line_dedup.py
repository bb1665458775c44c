import random
import re

import pytest

from curbsight.llm.line_dedup import LINE_WORDS, RUN_WORDS, Block, clean, without


def repeated(rows, run_words):
    """Numbers of the words in runs seen at an earlier place, by comparing words; lines and sentences play no part."""
    first, later = {}, {}
    for doc_id, text in sorted(rows):
        words = text.lower().split()
        for start in range(len(words) - run_words + 1):
            if first.setdefault(tuple(words[start : start + run_words]), (doc_id, start)) < (doc_id, start):
                later.setdefault(doc_id, set()).update(range(start, start + run_words))
    return later


def expected(rows, run_words):
    """Texts without the words found by ``repeated``, and on how many lines these were."""
    later, result = repeated(rows, run_words), {}
    for doc_id, text in rows:
        kept, line, lines = [], 0, set()
        # Odd parts are white space.
        for at, part in enumerate(re.split(r"(\s+)", text)):
            blank = at % 2 or not part
            number = at // 2 - (text[:1].isspace()) if not blank else gone and number
            gone = number in later.get(doc_id, ()) if not blank else at and gone
            if not gone:
                kept.append(part)
            elif not blank:
                lines.add(line)
            line += part.count("\n")
        result[doc_id] = ("".join(kept).strip(), len(lines)) if later.get(doc_id) else (text, 0)
    return result


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(docs, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(9)]
    pool += [p.upper() + " " for p in pool[:2]] + ["", "\u00a0\t"]
    rows = [(i, rng.choice(["\n", ". ", "\n\n", "! ", " "]).join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    found = clean(docs(rows), run_words=12, line_words=4).collect()
    assert {r.doc_id: (r.text, r.removed_lines) for r in found} == expected(rows, 12)


def test_every_repeated_run_shares_a_selected_line():
    rng = random.Random(9)
    for _ in range(200):
        passage = [rng.choice("abcdef") for _ in range(rng.randint(RUN_WORDS, 2 * RUN_WORDS))]
        texts = [" ".join([f"x{rng.random()}"] * rng.randint(0, 70) + passage + [f"z{rng.random()}"] * rng.randint(0, 70)) for _ in range(2)]
        line, _, row, *_ = Block(texts).selected(RUN_WORDS, LINE_WORDS)
        assert set(line[row == 0].tolist()) & set(line[row == 1].tolist())


def of_words(*sizes, between="\n", name="w"):
    """A text of lines with so many words, all different."""
    numbers = iter(range(sum(sizes)))
    return between.join(" ".join(f"{name}{next(numbers)}" for _ in range(n)) for n in sizes)


@pytest.mark.parametrize("sizes", [(50, 45), (30, 25, 10), (60, 10, 10, 10)])
def test_a_run_goes_to_its_last_line(docs, sizes):
    passage = of_words(*sizes)
    found = {r.doc_id: r.text for r in clean(docs([(1, f"a b\n{passage}\nc d"), (2, f"e f\n{passage}\ng h")])).collect()}
    assert found == {1: f"a b\n{passage}\nc d", 2: "e f\ng h"}


def test_a_run_goes_inside_a_sentence_and_wrapped_otherwise(docs):
    passage = of_words(120, between=" ")
    words = passage.split()
    wrapped = ["\n".join(" ".join(words[i : i + n]) for i in range(0, 120, n)) for n in (10, 12)]
    rows = [(1, f"One start {wrapped[0]} goes on."), (2, f"Another one, {passage} and ends."), (3, f"third\n{wrapped[1].upper()}\nlast")]
    found = {r.doc_id: (r.text, r.removed_lines, r.removed_words) for r in clean(docs(rows)).collect()}
    assert found == {1: (rows[0][1], 0, 0), 2: ("Another one, and ends.", 1, 120), 3: ("third\nlast", 10, 120)}


def test_two_texts_match_each_other_where_the_first_place_of_a_line_does_not(docs):
    """The line between is also in document 1, with other words around it."""
    line, left, right = of_words(20), of_words(25, name="l"), of_words(25, name="r")
    rows = [(1, f"x {line} y"), (2, f"{left} {line} {right} p"), (3, f"q {left} {line} {right}"), (4, f"{left} {line} s")]
    found = {r.doc_id: r.text for r in clean(docs(rows)).collect()}
    assert found == {1: rows[0][1], 2: rows[1][1], 3: "q", 4: rows[3][1]}


def test_a_text_that_repeats_itself_leaves_one_period(docs):
    period = of_words(7)
    found = {r.doc_id: r.text for r in clean(docs([(1, " ".join([period] * 40)), (2, "word " * 3_000)])).collect()}
    assert found == {1: period, 2: "word"}


def test_long_words_and_long_texts_are_read_whole(docs):
    """Texts of several blocks of letters, one of them a single word."""
    rng = random.Random(2)
    passage, blob = of_words(70), "z" * 700_000
    text = " ".join(f"{rng.random()}" for _ in range(40_000))
    rows = [(1, f"{text} {blob} {passage}"), (2, f"a {passage} b {blob}")]
    found = {r.doc_id: r.text for r in clean(docs(rows)).collect()}
    assert found == {1: rows[0][1], 2: f"a b {blob}"}


def test_passages_of_fifty_words_go_and_shorter_ones_stay(docs):
    passage = ". ".join(" ".join(f"w{i}{j}" for j in range(10)).capitalize() for i in range(5))
    short = ". ".join(passage.split(". ")[:4])
    rows = [(1, f"One start. {passage}. One end."), (2, f"Other begin. {passage}. Other end."), (3, f"Third. {short}. End.")]
    found = {r.doc_id: r.text for r in clean(docs(rows)).collect()}
    assert found == {1: rows[0][1], 2: "Other begin. Other end.", 3: rows[2][1]}


def test_odd_rows(docs):
    text = "\n".join(f"line {i} of a text that is long enough" for i in range(20))
    rows = [(5, text), (5, text), (7, text), (None, text), (8, None), (9, ""), (10, " ".join(["word"] * 100_000))]
    frame = docs(rows, "hash", "line", "span", "removed_lines", "removed_words", "start", "runs")
    found = sorted(((r.doc_id, r.text, r.removed_lines) for r in clean(frame).collect()), key=str)
    # The null id comes first and keeps its lines.
    wanted = [(5, "", 20), (5, "", 20), (7, "", 20), (None, text, 0), (8, None, 0), (9, "", 0), (10, "word", 1)]
    assert found == sorted(wanted, key=str)
    assert set(clean(frame).columns) == set(frame.columns)
    assert clean(docs([])).collect() == []


def test_texts_of_one_id_are_told_apart(docs):
    text = "\n".join(f"line {i} of a text that is long enough" for i in range(20))
    other = "\n".join(f"another line {i} that only starts like this" for i in range(20))
    mixed = "\n".join([other, text])
    for i in (None, 4):
        found = sorted(r.text for r in clean(docs([(i, other), (i, other), (3, text), (i, mixed)])).collect())
        assert sorted(set("\n".join(found).split("\n")) - {""}) == sorted({*text.split("\n"), *other.split("\n")})


def test_a_repeated_id_alone_stays(docs):
    text = "\n".join(f"line {i} of a text that is long enough" for i in range(20))
    assert [r.text for r in clean(docs([(5, text), (5, text)])).collect()] == [text, text]


def test_nothing_to_cut_leaves_a_text_as_it_is():
    assert without(" One.  Two! \n", []) == ("One.  Two!", 0, 0)
    assert without("a b\nc d\ne", [(1, 3), (2, 4)]) == ("a e", 2, 3)


def test_a_line_is_no_longer_than_a_run(docs):
    with pytest.raises(ValueError, match="line"):
        clean(docs([(1, "a")]), run_words=5, line_words=6)
