"""The suffix sort and the byte dedup against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import suffixes as S
from tessera.llm.queries import op13_suffix_sort

SHARED = "a passage of more than fifty bytes that several of the documents hold, é and ß too. "


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=60, max_size=400).map(lambda b: bytes(97 + x % 2 for x in b)), st.integers(16, 50))
def test_classes_are_ranks_of_the_prefixes(raw, depth):
    data = np.frombuffer(raw + raw[:55], np.uint8)
    at = np.arange(len(data) - depth + 1)
    keys = [data[i:i + depth].tobytes() for i in at]
    rank = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert S.suffix_classes(data, at, depth).tolist() == [rank[k] for k in keys]


def test_common_extension_orders_suffixes():
    data = np.frombuffer(b"x" * 40 + b"b" + b"x" * 40 + b"a" + b"x" * 60, np.uint8)
    text = S.Prefix(data)
    assert S.compare(text, np.array([0, 41, 0]), np.array([41, 0, 0]), 0, 50).tolist() == [1, -1, 0]


def test_collisions_are_settled_on_bytes(monkeypatch):
    """With hashes that are all equal, neighbours agree by hash and differ by bytes."""
    monkeypatch.setattr(S, "_BYTE", np.zeros(256, np.uint64))
    rng = np.random.default_rng(4)
    data = np.concatenate([np.tile(np.frombuffer(b"the same sixteen", np.uint8), 2), rng.integers(97, 100, 60).astype(np.uint8)] * 4)
    at = np.arange(len(data) - 49)
    keys = [data[i:i + 50].tobytes() for i in at]
    rank = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert S.suffix_classes(data, at).tolist() == [rank[k] for k in keys]


def brute(rows):
    first = {}
    key = lambda i: S.LAST if i is None else i
    for i, x in rows:
        b = (x or "").encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], S.LAST), key(i))
    out = []
    for i, x in rows:
        b = (x or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < key(i):
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(v for v, q in zip(b, gone) if not q)
        out.append((i, len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice([f"w{i}" for i in range(300)], n))


ROWS = ([(i, prose(60 + i, i)) for i in range(12)]
        + [(20, prose(30, 1) + SHARED), (21, SHARED + prose(25, 2)), (22, SHARED[3:60] + "!" + SHARED[20:]), (23, prose(60, 0)),
           (24, None), (25, ""), (26, "short"), (27, "x" * 49), (28, "x" * 50), (29, "x" * 51), (30, "x" * 5000), (31, "ab" * 900),
           (None, SHARED), (None, SHARED + "tail"), (32, prose(60, 0)), (32, prose(60, 0)), (33, prose(60, 0)[:-3] + SHARED),
           (-5, prose(9000, 77)), (34, prose(9000, 77)[100:30000])]
        + [(100 + i, f"{i * 7919} {i} begins " + SHARED + prose(5, i)) for i in range(60)])


@pytest.mark.parametrize("chunk,hot", [(2 << 20, 64), (4000, 64), (4000, 2)])
def test_equal_to_brute_force(spark, chunk, hot):
    extra = [(i, t, "a", 1, 2) for i, t in ROWS]
    docs = spark.createDataFrame(extra, "doc_id long, text string, kept string, n_removed int, __chunk int").repartition(3)
    got = S.remove_repeated_bytes(docs, keep=docs.columns, chunk_bytes=chunk, hot=hot)
    assert got.columns == [*docs.columns, "n_bytes", "_n_removed", "_kept", "removed"]
    rows = got.collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["_n_removed"], len(r["removed"]), hashlib.sha256(r["_kept"]).hexdigest()) for r in rows),
                  key=str) == brute(ROWS)
    for r in rows:
        b = (r["text"] or "").encode()
        spans = [(x["start"], x["end"]) for x in r["removed"]]
        assert bytes(r["_kept"]) == b"".join(b[e:s] for e, s in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(b)]))
        assert (r["kept"], r["n_removed"]) == ("a", 1)


def test_report_and_empty_table(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert sorted((tuple(r) for r in S.suffix_report(docs).collect()), key=str) == brute(ROWS)
    assert S.suffix_report(docs.where("1 = 0")).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in S.suffix_report(nulls).collect()) == [0, 0]


def test_a_null_id_has_no_smaller_one(spark, tmp_path):
    """The query by its contract: no doc_id is smaller than a null one, so its row keeps what others hold."""
    rows = [*ROWS, (None, prose(60, 0)), (None, "é" * 60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute([(i, t) for i, t in rows if i is not None])
    want += [(None, len(t.encode()), 0, 0, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows if i is None]
    got = [tuple(r) for r in op13_suffix_sort(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
