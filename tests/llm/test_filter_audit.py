"""The byte transducer and the filter audit against plain versions."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import parity
import pyarrow as pa
import pytest
from brute import split_words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.llm.byte_transducer import SYMBOLS, class_table, counted, first_spans
from tarnlake.llm.filter_audit import audit_filters
from tarnlake.llm.oracles import FILTERS
from tarnlake.llm.queries import op13_filters

SCHEMA = "doc_id long, text string, lang string"
MARKS = "doc_id long, quality int, toxic int"


def plain_counts(text):
    text, words = text or "", split_words(text)
    return {
        "words": len(words),
        "distinct_words": len(set(words)),
        "capitals": len(re.findall("[A-Z]", text)),
        "symbols": len(re.findall("[#$%&*|]", text)),
        "code_points": len(text),
    }


def transduced(texts):
    found = counted(pa.array(texts, pa.string()), class_table())
    return [{name: int(values[i]) for name, values in found.items()} for i in range(len(texts))]


TEXTS = [None, "", " ", "a", "A b A", "\x0b\x0c x\r\ny", "naïve É 日本 日本", "# $ % & * |", "\x1f\xa0 é", "x" * 5000, "a a " * 900]


def test_counts_of_texts():
    assert transduced(TEXTS) == [plain_counts(t) for t in TEXTS]
    assert transduced([]) == []


def test_counts_of_a_slice():
    whole = pa.array(TEXTS, pa.string()).slice(3, 5)
    found = counted(whole, class_table())
    assert [int(x) for x in found["words"]] == [plain_counts(t)["words"] for t in TEXTS[3:8]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tabAB#é日\x0b", max_size=40), max_size=8))
def test_counts_of_drawn_texts(texts):
    assert transduced(texts) == [plain_counts(t) for t in texts]


def test_words_of_one_hash_are_told_apart():
    """Every span has the same hash, so the bytes alone decide."""
    words = ["aa", "bb", "aa", "cc", "bb", "aa"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    starts, sizes = np.arange(0, 12, 2), np.full(6, 2)
    text = np.array([0, 0, 0, 0, 1, 1])
    first = first_spans(data, text, starts, sizes, np.zeros(6, np.uint64))
    assert first.tolist() == [True, True, False, True, True, True]


def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    failed = []
    for doc, text, lang in docs:
        c = plain_counts(text)
        fails = {
            "A": c["words"] < 200,
            "B": 100 * c["distinct_words"] < 50 * c["words"],
            "C": 100 * c["capitals"] > 3 * c["code_points"],
            "D": c["symbols"] > 0,
            "E": doc is not None and doc > least[text or ""],
        }
        failed.append((lang or "", doc, {k for k, v in fails.items() if v}))
    result, removed_in_all = {}, Counter()
    for order in permutations("ABCDE"):
        for step, letter in enumerate(order, 1):
            for part in {p for p, _, _ in failed}:
                rows = [(d, f) for p, d, f in failed if p == part]
                before = set(order[: step - 1])
                removed = [(d, f) for d, f in rows if letter in f and not f & before]
                removed_in_all[part, letter] += len(removed)
                result[part, "".join(order), step] = [
                    sum(not f & (before | {letter}) for _, f in rows),
                    len(removed),
                    sum(letter in f and bool(f & before) for _, f in rows),
                    sum(f == {letter} for _, f in rows),
                    sum(d in good for d, _ in removed),
                    sum(d in toxic for d, _ in removed),
                ]
    for (part, order, step), row in result.items():
        row.append(removed_in_all[part, order[step - 1]])
    return result


def audited(spark, docs, labels):
    clashing = {n: F.lit(1) for n in ("part", "failed", "n", "step", "words", "good", "repeated", "__first")}
    frame = spark.createDataFrame(docs, SCHEMA).withColumns(clashing)
    found = audit_filters(frame, spark.createDataFrame(labels, MARKS).withColumn("extra", F.lit(2))).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    result = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in found}
    assert len(result) == len(found)
    return result


LONG = " ".join(f"word{i}" for i in range(300))
ODD = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (1, LONG, "de"), (3, None, None), (4, "", "en"), (None, "", "en"),
    (None, LONG, None), (None, None, None), (5, "A B # C", "de"), (6, "to be " * 200, "de"), (7, LONG.upper() + " %", "en"),
    (8, "naïve " * 300, "fr"), (9, "x" * 20_000, "fr"), (10, " ".join(f"w{i}" for i in range(30_000)), "fr"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 1), (4, None, 1), (None, 1, 1), (99, 1, 1), (7, 1, None), (8, 1, 0)]


def test_odd_rows(spark):
    assert audited(spark, ODD, LABELS) == plain_audit(ODD, LABELS)


def test_large_marks_and_repeats_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr("tarnlake.llm.staging.SMALL_ROWS", 0)
    assert audited(spark, ODD, LABELS) == plain_audit(ODD, LABELS)


def test_no_documents(spark):
    assert audited(spark, [], LABELS) == {}


def test_no_labels(spark):
    found = audited(spark, ODD, [])
    assert found == plain_audit(ODD, [])


def test_all_orders_and_steps_of_each_part(spark):
    found = audited(spark, [(1, "one", "xx")], [])
    assert len(found) == 600
    assert {part for part, _, _ in found} == {"xx"}


@pytest.mark.parametrize("folder", ["corpus"])
def test_query_equals_its_sql(spark, request, folder):
    folder = request.getfixturevalue(folder)
    assert parity.difference(op13_filters(spark, folder), folder, FILTERS) is None


def test_symbols_are_ascii():
    assert all(symbol < 0x80 for symbol in SYMBOLS)
