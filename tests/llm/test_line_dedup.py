import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shopsignals.llm import line_dedup as ld
from tests.llm import helpers as h

def numbers(text):
    return [int(x) for x in text.split(",") if x]


W = re.compile(r"[^\x20\x09-\x0D]+")


def mask(line):
    return " ".join("<*>" if re.search("[0-9]", w) else w for w in W.findall(line))


def brute(docs):
    """Line numbers to drop per document, walking the tree in plain Python."""
    tree = defaultdict(lambda: defaultdict(list))
    for r in docs:
        if r["doc_id"] is not None:
            for m in {mask(line) for line in (r["text"] or "").split("\n")}:
                w = m.split(" ")
                if m and set(w) != {"<*>"}:
                    tree[len(w), tuple(w[:4])][m].append(r["doc_id"])
    ids_of = defaultdict(set)
    family_of = {}
    for leaf, lines in tree.items():
        support, holders = Counter(), Counter()
        for m, ids in lines.items():
            for cell in enumerate(m.split(" ")[4:]):
                support[cell] += len(ids)
                holders[cell] += 1
        held, candidates = Counter(), {}
        for m, ids in lines.items():
            cells = list(enumerate(m.split(" ")[4:]))
            shared = sorted((c for c in cells if holders[c] > 1), key=lambda c: (-support[c], c[0]))
            candidates[m] = [frozenset(shared[:k]) for k in range(1, len(shared) + 1) if 10 * k >= 8 * len(cells)]
            for c in candidates[m]:
                held[c] += len(ids)
        takers = Counter(c for found in candidates.values() for c in found)
        for m, ids in lines.items():
            found = [c for c in candidates[m] if takers[c] > 1]
            family_of[m] = (leaf, max(found, key=lambda c: (held[c], len(c)))) if found else m
            ids_of[family_of[m]].update(ids)
    keeper = {m: min(ids_of[f]) for m, f in family_of.items()}
    return [
        (r["doc_id"], [i for i, x in enumerate((r["text"] or "").split("\n")) if r["doc_id"] is not None and keeper.get(mask(x), r["doc_id"]) != r["doc_id"]])
        for r in docs
    ]


def corpus(n=120):
    rng = random.Random(6)
    rows = []
    passage = " ".join(f"p{chr(97 + i % 26)}x{chr(97 + i // 26)}" for i in range(55))
    for i in range(n):
        lines = [h.sentence(rng, rng.randrange(1, 15)) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), f"posted on 2024-01-{i:02d} by user{i} from the {rng.choice(h.VOCAB)} office")
        if i % 5 == 0:
            lines.append(f"see the full terms of service for region {rng.choice(h.VOCAB)} at our main site today")
        if i % 20 == 1:
            lines.append("  " + passage.replace(" ", "\t", 2) + " ")
        rows.append(h.row(i, "\n".join(lines)))
    return rows


def test_matches_the_plain_tree(spark):
    df = spark.createDataFrame(corpus(), h.DOCS_DDL).repartition(4)
    got = sorted((r["doc_id"], numbers(r["dropped"])) for r in ld.line_dedup(h.clashing(df)).collect())
    want = sorted(brute(df.collect()))
    assert got == want and sum(len(x) for _, x in want) > 50


def test_passages_and_variable_fields_go_and_clean_lines_stay(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, h.DOCS_DDL)
    out = {r["doc_id"]: r for r in ld.cleaned_documents(df).collect()}
    assert ld.cleaned_documents(df).columns == df.columns and len(out) == len(rows)
    assert sum("pax" in r["text"] for r in out.values()) == 1
    assert sum("posted on" in r["text"] for r in out.values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())
    unique = {i: [x for x in t.split("\n") if len(x.split()) > 9 and "posted" not in x and "terms of" not in x and "pax" not in x] for i, t, *_ in rows}
    assert all(x in out[i]["text"].split("\n") for i, lines in unique.items() for x in lines)


def left_over(spark, rows):
    return {r["doc_id"]: r["text"] for r in ld.cleaned_documents(spark.createDataFrame(rows, h.DOCS_DDL).repartition(3)).collect()}


def test_two_templates_of_one_leaf_have_their_own_first_documents(spark):
    acme, zenith = "copyright notice of the acme books company rights reserved", "copyright notice of the zenith music house under licence"
    out = left_over(spark, [h.row(1, acme), h.row(2, acme), h.row(3, zenith), h.row(4, zenith + "\nown line")])
    assert out == {1: acme, 2: "", 3: zenith, 4: "own line"}


@pytest.mark.parametrize("others", [0, 500])
def test_other_lines_of_the_leaf_hide_no_template(spark, others):
    rng = random.Random(3)
    rows = [h.row(i, f"read the full story of {rng.choice(h.VOCAB)}{chr(97 + i % 26)} in our evening paper") for i in range(40)]
    rows += [h.row(1000 + i, "read the full story " + " ".join(f"{rng.choice(h.VOCAB)}{chr(97 + rng.randrange(26))}" for _ in range(6))) for i in range(others)]
    out = left_over(spark, rows)
    assert [i for i in range(40) if out[i]] == [0]
    assert sum(bool(out[1000 + i]) for i in range(others)) == others


def test_short_lines_and_lines_of_fields(spark):
    out = left_over(spark, [h.row(1, "Menu\n12 34\nlog in\n7"), h.row(2, "Menu\n56 78\nlog in\n8"), h.row(3, "Menu 3\nlog in")])
    assert out == {1: "Menu\n12 34\nlog in\n7", 2: "56 78\n8", 3: "Menu 3"}


def test_clashing_and_dotted_columns(spark):
    df = spark.createDataFrame([h.row(1, "same words here"), h.row(2, "same words here\nand more")], h.DOCS_DDL)
    odd = df.withColumns({c: F.lit("x") for c in ("_l_id", "_id", "_drop", "_all", "_lines", "_dropped", "a.b", "key", "drop")})
    out = ld.cleaned_documents(odd)
    assert out.columns == odd.columns and {r["doc_id"]: r["text"] for r in out.collect()} == {1: "same words here", 2: "and more"}


def test_awkward_rows(spark):
    df = h.awkward(spark)
    rows = ld.line_dedup(df).collect()
    assert sorted(((r["doc_id"], numbers(r["dropped"])) for r in rows), key=str) == sorted(brute(df.collect()), key=str)
    assert ld.line_dedup(h.empty(spark)).count() == 0
    kept = {str(r["doc_id"]): r["text"] for r in ld.cleaned_documents(df).collect()}
    assert kept["0"] is None and kept["1"] == "" and kept["7"] == "" and kept["6"] != "" and kept["None"] == kept["6"]
