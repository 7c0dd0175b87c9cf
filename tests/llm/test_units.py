"""How texts are cut into units, against a rule in plain Python."""

import random
import unicodedata

import pytest

from tenantferry.llm import lattice

SPACE = lattice.SPACE


def plain_units(text, marks):
    """White space with the word after it; a word ends before a mark that follows its first letters."""
    if not text:
        return []
    s, out, at = SPACE + text.replace(" ", SPACE), [], 0
    while at < len(s):
        end = at + 1
        if s[at] != "\n":
            while end < len(s) and s[at] == SPACE and s[end - 1] == SPACE and s[end] == SPACE:
                end += 1
            end = end if s[at] == SPACE else at
            letters = lambda c: unicodedata.category(c)[0] == "L"
            i = end
            while i < len(s) and s[i] not in SPACE + "\n" and not letters(s[i]):
                i += 1
            j = i
            while j < len(s) and letters(s[j]):
                j += 1
            if i < j < len(s) and s[j] in marks:
                end = j
            else:
                while end < len(s) and s[end] not in SPACE + "\n":
                    end += 1
        out.append(s[at:end])
        at = end
    return out


@pytest.mark.parametrize("pieces", [["<unk>", "a", SPACE], ["<unk>", "a.", "é,", SPACE]])
def test_units_equal_a_plain_rule(spark, pieces):
    v = lattice.Vocabulary(pieces, [0.0] * len(pieces), [2] + [1] * (len(pieces) - 1), True, True)
    r = random.Random(5)
    texts = ["", " ", "\n", "a.b", "..a,,b", "a\n\nb", "x-y.", "1a2.", None] + ["".join(r.choices(" \n.,;:aé文1-\t▁", k=r.randrange(40))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {x.id: x.us for x in rows.select("id", lattice.units(rows.text, v).alias("us")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_units(t, v.cuts()), t


def test_a_word_is_walked_over_once(spark):
    v = lattice.Vocabulary(["<unk>", "a"], [0.0, 0.0], [2, 1], True, True)
    text = str(lattice.units(spark.createDataFrame([("a",)], "text string").text, v))
    assert "translate" not in text and text.count("p{L}++") == 1 and "++(?:(?=" in text
