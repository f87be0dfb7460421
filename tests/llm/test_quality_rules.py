import random
import re
from collections import Counter

from shopsignals.llm import quality_rules as rules
from tests.llm import helpers as h

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = W.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if W.search(x)]
    n, repeat = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat, n < 50 or 100 * repeat > 50 * n


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_match_brute_force(spark):
    extra = [
        h.row(20, "a b c a b c a b c"), h.row(21, "x x x x"), h.row(22, "# one ## | <b> two$\n# one ## | <b> two$\n\n\n"),
        h.row(23, "é ü ß q\x85z \x0c end"), h.row(24, "a b c\nd a b c d"),
    ]
    df = h.awkward(spark, extra)
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in df.collect()), key=str)
    got = sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in rules.quality_rules(h.clashing(df)).collect()), key=str)
    assert got == want


def test_verdicts(spark):
    rng = random.Random(4)
    good = " ".join(rng.choice(["the", "of", "and", *h.VOCAB]) + rng.choice(["", ".", ","]) for _ in range(120))
    rows = [
        h.row(1, good),
        h.row(2, " ".join(f"word{i}###" for i in range(80))),
        h.row(3, " ".join(f"THE{chr(65 + i % 26)}{i}" for i in range(80))),
        h.row(4, "same line of the text and more\n" * 20),
        h.row(5, "too short of the"),
    ]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in rules.quality_rules(spark.createDataFrame(rows, h.DOCS_DDL)).collect()}
    assert got[1] == (False, True)
    assert got[2] == (False, False) and got[3] == (False, False)
    assert got[4] == (True, False) and got[5] == (True, False)


def test_empty_table_and_plan(spark):
    df = rules.quality_rules(h.empty(spark))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
