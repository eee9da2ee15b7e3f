"""Long words and lines, numerals, extra columns of any name, groups of equal rows, and the pipeline stage by stage."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import langid, mixing, neardup, packing, perplexity, substrings
from tessera.llm.blocks import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(n, seed, stem="w"):
    return " ".join(np.random.default_rng(seed).choice([f"{stem}{i}" for i in range(300)], n))


# ---------------------------------------------------------------- words and lines of many bytes

BLOCK = 1 << 16
SWAPPED = ["a" * BLOCK + "b" * BLOCK, "b" * BLOCK + "a" * BLOCK, "a" * BLOCK + "b" * BLOCK + "c" * 70_000,
           "c" * 70_000 + "a" * BLOCK + "b" * BLOCK, "a" * (2 * BLOCK), "a" * BLOCK]


def test_long_words_whose_blocks_change_places_differ():
    h = words(pa.array(SWAPPED + SWAPPED[:2])).hashes().tolist()
    assert len(set(h)) == len(SWAPPED) and h[:2] == h[-2:]


def test_substrings_with_long_words(spark):
    head = prose(12, 1)
    docs = [(1, f"{head} {SWAPPED[0]}"), (2, f"{head} {SWAPPED[1]}"), (3, f"x {head} {SWAPPED[1]} y")]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.substring_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 13}


def test_base_counts_with_long_lines_and_words():
    line = "a" * BLOCK + " " + "b" * BLOCK
    other = "b" * BLOCK + " " + "a" * BLOCK
    eight = lambda w: " ".join([w] + ["s"] * 7)
    texts = [f"{line}\n{other}\n{line}", f"{eight(SWAPPED[0])} t {eight(SWAPPED[1])}", f"{eight(SWAPPED[0])} t {eight(SWAPPED[0])}"]
    n_words, _, _, lines, repeat = perplexity.base_counts(words(pa.array(texts)))
    assert n_words.tolist() == [6, 17, 17] and lines.tolist() == [1, 0, 0] and repeat.tolist() == [0, 0, 16]


def test_near_duplicates_with_long_words(spark):
    body = prose(8, 3)
    docs = [(1, f"{body} {SWAPPED[0]}"), (2, f"{body} {SWAPPED[1]}"), (3, prose(40, 4)), (4, prose(40, 4) + " end")]
    got = {r["doc_id"]: r["class_id"] for r in neardup.duplicate_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # 5 and 5 shingles, of which 4 are shared: 4 of 6.
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_numerals_are_no_letters(spark):
    docs = [(i, prose(30, i, "alba"), "xx") for i in range(40)] + [(i, prose(30, i, "zork"), "yy") for i in range(40, 80)]
    odd = ["½ ² ① Ⅷ", "٣ 12 %", "𝟙 ↉ ㊿"]
    docs += [(100 + i, t, None) for i, t in enumerate(odd)] + [(200, "² alba ½ alba zzz", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert [got[100 + i] for i in range(len(odd))] == ["und"] * 3 and got[200] == "xx"
    assert langid.fold("Éa ² Ⅷ b½C") == "éa b c"


# ---------------------------------------------------------------- extra columns and equal rows

CLASHING = ["score", "rejected", "lang_pred", "n_words", "n_removed", "kept_text", "removed", "__k", "__n", "__id", "__i", "__d", "__size",
            "__take", "n", "key", "size", "copies", "first", "whole", "id", "comp", "__extra0"]


def clashing(docs):
    return docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c) for c in CLASHING])


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def vocabulary(letters, seed):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(letters), rng.integers(3, 8))) for _ in range(250)]


TONGUES = {"xx": vocabulary("abcdefghilm", 1), "yy": vocabulary("nopqrstuvz", 2)}


def speech(n, seed, lang="xx"):
    return " ".join(np.random.default_rng(seed).choice(TONGUES[lang], n))


PASSAGE = speech(60, 99)


@pytest.fixture()
def corpus(spark):
    rows = [(i, speech(60 + i % 50, i, la), la, "abc"[i % 3]) for i in range(120) for la in ["xx" if i % 2 else "yy"]]
    rows += [(200 + i, speech(60, 1001) + (" more" if i % 2 else ""), "xx", "a") for i in range(6)]
    rows += [(300 + i, speech(30, 300 + i) + " " + PASSAGE + " " + speech(30, 400 + i), "xx", None) for i in range(5)]
    rows += [(None, speech(50, 500, "yy"), "yy", "b")] * 3 + [(310, None, None, "c"), (311, "", "xx", "c"), (312, "1 2 3", None, None)]
    return table(spark, rows)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stages_keep_extra_columns_of_any_name(spark, corpus, stage):
    docs = clashing(corpus)
    got = stage[1](spark, docs, "").collect()
    assert got and got[0].asDict().keys() == {*docs.columns}
    plain = stage[1](spark, corpus, "").select("doc_id", "text")
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == collections.Counter(map(tuple, plain.collect()))
    for r in got:
        assert all(r[c] == f"{c}-{'null' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)


def test_mixing_deals_equal_rows_one_by_one(spark):
    """A third of all rows are one repeated row, another group has a null key; totals are those of the report."""
    rows = [(i, prose(20 + i % 9, i), "xx", "ab"[i % 2]) for i in range(300)]
    rows += [(7000, "one two three four", "xx", "a")] * 200 + [(None, f"x y z {i}", "xx", "b") for i in range(100)]
    docs = table(spark, rows).repartition(5)
    report = mixing.mix_report(docs).collect()
    assert len(report) == len(rows)
    want = collections.Counter()
    for r in report:
        want[r["doc_id"]] += r["copies"]
    mixed = mixing.mix_documents(docs).collect()
    got = collections.Counter(r["doc_id"] for r in mixed)
    assert got == +want
    per_text = collections.Counter(r["text"] for r in mixed if r["doc_id"] is None)
    assert set(per_text.values()) <= {1, 2} and sum(per_text.values()) == want[None]


# ---------------------------------------------------------------- the pipeline

def shingles(text):
    w = WORD.findall(text or "")
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or collections.Counter([tuple(w)] if w else [])


def test_pipeline_stage_by_stage(spark, corpus):
    docs = clashing(corpus)
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = (now, stage(spark, now, "").checkpoint())
        now = seen[name][1]
    rows = lambda df: df.select("doc_id", "text", "source").collect()
    # Language ID: what the classifier does not reject, unchanged.
    before, after = seen["language_id"]
    verdict = {r["doc_id"]: r["rejected"] for r in langid.identify(before).collect()}
    assert collections.Counter(map(tuple, rows(after))) == collections.Counter(tuple(r) for r in rows(before) if not verdict[r["doc_id"]])
    assert {r["doc_id"] for r in rows(after)} & {310, 311, 312} == set() and after.count() > 120
    # Near duplicates: no two rows left that are near, and each row that went is near one that goes too or stays.
    before, after = seen["near_dedup"]
    left, gone = [shingles(r["text"]) for r in rows(after)], collections.Counter(map(tuple, rows(before))) - collections.Counter(map(tuple, rows(after)))

    def alike(a, b):
        return sum((a & b).values()) / max(1, sum((a | b).values()))
    assert all(alike(a, b) < 0.8 for i, a in enumerate(left) for b in left[:i])
    every = [shingles(r["text"]) for r in rows(before)]
    assert sum(gone.values()) == before.count() - after.count() == 7  # five copies, two repeated rows
    assert all(sum(alike(shingles(t), b) >= 0.8 for b in every) >= 2 for _, t, _ in gone)
    # Substrings: words covered by a 13-word window that starts in a smaller id go.
    before, after = seen["substring_dedup"]
    first = {}
    for r in rows(before):
        w = WORD.findall(r["text"])
        for j in range(len(w) - 12):
            k = tuple(w[j:j + 13])
            first[k] = min(first.get(k, (1, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
    want = collections.Counter()
    for r in rows(before):
        w, own = WORD.findall(r["text"]), (r["doc_id"] is None, r["doc_id"] or 0)
        out = [False] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j:j + 13])] < own:
                out[j:j + 13] = [True] * 13
        kept = [x for x, g in zip(w, out) if not g]
        if kept or not any(out):
            want[(r["doc_id"], " ".join(kept) if any(out) else r["text"])] += 1
    assert collections.Counter((r["doc_id"], r["text"]) for r in rows(after)) == want
    assert sum(PASSAGE in t for _, t in want.elements()) == 1
    # Mixing: as often as the report says.
    before, after = seen["mixing"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_report(before).collect()}
    assert collections.Counter(r["doc_id"] for r in rows(after)) == collections.Counter({i: n for i, n in copies.items() if n})
    # Packing: every id of every row in one piece.
    before, after = seen["packing"]
    tokenizer, size, got = packing.Encoder(packing.default_tokenizer()).tok, collections.Counter(), collections.Counter()
    for r in rows(before):
        size[r["doc_id"]] += len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
    for r in after.collect():
        got[r["doc_id"]] += r["length"]
    assert got == size
