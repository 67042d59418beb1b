"""Repeated passages, filter interaction and fill-in-the-middle against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import fill_in_middle, filter_audit, super_kmers
from isobar.llm.common import unpacked


# -- repeated passages -----------------------------------------------------------

def brute_strip(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc, b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), len(w), len(gone)))
    return Counter(out)


def stripped(docs, **options):
    return Counter(tuple(r) for r in super_kmers.strip_repeats(docs, **options).select("doc_id", "text", "n_words", "n_removed").collect())


@pytest.mark.parametrize("window, gram, group, block", [(35, 8, 512, 2 << 20), (35, 8, 1, 3000), (5, 2, 3, 500), (4, 4, 512, 500), (3, 1, 2, 200)])
def test_passages_equal_brute_force(spark, documents, odd, monkeypatch, window, gram, group, block):
    monkeypatch.setattr(super_kmers, "BLOCK_BYTES", block)
    rng = random.Random(window)
    word = lambda: rng.choice(["a", "bb", "été", "漢字", "longer-than-eight", "longer-than-nine!", "x y"])
    passage = [" ".join(f"p{i}w{j}" for j in range(60)) for i in range(3)]
    rows = []
    for i in range(120):
        own = [f"u{i}x{rng.randrange(10**6)}" for _ in range(rng.randrange(60))]
        few = [word() for _ in range(rng.randrange(50))]
        shared = passage[rng.randrange(3)].split()[rng.randrange(20):] if rng.random() < 0.4 else []
        rows.append((i, rng.choice([" ", "\n", "\t \r\n"]).join([*own, *shared, *few, *own[:7]])))
    rows += [(900, "same " * 400), (901, "same other " * 90), (902, "\x0b\x0c lone\x0bwords "), *[(1000 + i, "copy " + passage[0]) for i in range(40)]]
    docs = documents(*rows).unionByName(odd).repartition(3)
    expected = brute_strip([(r.doc_id, r.text) for r in docs.collect()], window)
    assert stripped(docs, window=window, gram=gram, group=group) == expected


def test_many_repeated_rows_and_clashing_columns(spark, documents):
    line = " ".join(f"w{i}" for i in range(40))
    docs = documents((1, line), (2, "own words"), (3, None)).withColumns(
        {"block": F.lit("b"), "flat": F.lit(1), "n_words": F.lit("mine"), "key": F.col("doc_id"), "places": F.lit(None).cast("string")})
    many = docs.unionByName(docs.where("doc_id = 1").select("*", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("_")).drop("_"))
    found = super_kmers.strip_repeats(many)
    assert sorted(found.columns) == sorted(docs.columns + ["n_removed"])
    assert found.where("doc_id = 1 AND n_removed = 40 AND text = '' AND n_words = 40 AND block = 'b' AND key = 1").count() == 3001
    assert {(r.doc_id, r.text) for r in found.where("doc_id > 1").collect()} == {(2, "own words"), (3, "")}
    assert super_kmers.strip_repeats(docs.limit(0)).count() == 0


def test_equal_windows_have_equal_minimisers():
    rng = np.random.default_rng(1)
    words = [f"w{i}".encode() for i in rng.integers(0, 300, 4000)]
    cut = [0, 7, 7, 1500, 4000]
    block = super_kmers.Block(b" ".join(words), np.diff(cut), 35, 8)
    windows = [(int(f) + j, int(k)) for f, w, k in zip(block.first, block.width, block.key) for j in range(w)]
    inside = [i for a, b in zip(cut, cut[1:]) for i in range(a, b - 34)]
    assert [i for i, _ in windows] == inside  # each window is in one super-k-mer
    assert len(block.first) < len(inside) / 8  # several windows travel together
    again = super_kmers.Block(b" ".join([b"other"] * 3 + words[100:200]), np.array([103]), 35, 8)
    assert {k for i, k in windows if i == 110} <= set(again.key.tolist())


# -- filter interaction -----------------------------------------------------------

def brute_flags(rows, labels):
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    good = {d for d, q, t in labels if q == 1}
    toxic = {d for d, q, t in labels if t == 1}
    for doc, text, source in rows:
        text, words = text or "", (text or "").encode().split()
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": doc is not None and doc > least[text]}
        yield source or "", {k for k, v in fails.items() if v}, doc in good, doc in toxic


def brute_audit(flags):
    flags, out = list(flags), {}
    for part in {f[0] for f in flags}:
        own = [f for f in flags if f[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, here in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [f for f in own if here in f[1] and not before & f[1]]
                shapley[here] += len(removed)
                out[part, order, step] = [
                    sum(not set(order[:step]) & f[1] for f in own), len(removed), sum(here in f[1] and bool(before & f[1]) for f in own),
                    sum(f[1] == {here} for f in own), sum(f[2] for f in removed), sum(f[3] for f in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


@pytest.mark.parametrize("block", [2 << 20, 400])
def test_audit_equals_brute_force(spark, documents, odd, monkeypatch, block):
    monkeypatch.setattr(filter_audit, "BLOCK_BYTES", block)
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["AB", "cd", "e#", "été", f"w{rng.randrange(99)}"]) for _ in range(rng.choice([3, 49, 50, 51, 80]))) for _ in range(25)]
    rows = [(rng.choice([None, rng.randrange(60)]), rng.choice(texts), None, rng.choice(["s1", "s2", None])) for _ in range(150)]
    docs = documents(*rows).unionByName(odd).withColumns({"part": F.lit(1), "digest": F.lit("x"), "good": F.lit(2)}).repartition(3)
    labels = [(rng.choice([None, rng.randrange(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(50)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("other"))
    found = filter_audit.audit(filter_audit.flagged(docs, frame))
    expected = brute_audit(brute_flags([(r.doc_id, r.text, r.source) for r in docs.collect()], [r for r in labels if r[0] is not None]))
    assert {tuple(r) for r in found.collect()} == expected
    empty = filter_audit.flagged(docs.limit(0), frame.limit(0))
    assert filter_audit.audit(empty).count() == 0
    assert filter_audit.audit(filter_audit.flagged(docs, frame.limit(0))).where("good_lost + toxic_lost > 0").count() == 0


def test_matrix_of_the_documents(documents, odd, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK_BYTES", 300)
    docs = odd.unionByName(documents((20, "b a b c"), (21, "c\x0bb d d c"))).repartition(2)
    texts = {r.doc_id: (r.text or "").encode().split() for r in docs.where("doc_id is not null").collect()}
    ids, seen = {}, 0
    for s in filter_audit.document_term(docs).collect():
        indptr, indices, data = unpacked(s.indptr), unpacked(s.indices, "<i8"), unpacked(s.data)
        for row, (a, b) in zip(s.docs, zip(indptr, indptr[1:])):
            seen += 1
            assert len(set(indices[a:b].tolist())) == b - a
            if row.doc_id is not None:
                assert sorted(data[a:b].tolist()) == sorted(Counter(texts[row.doc_id]).values())
                ids[row.doc_id] = dict(zip(indices[a:b].tolist(), data[a:b].tolist()))
    assert seen == docs.count()
    b, c = ({i for i, n in ids[20].items() if n == 2}, set(ids[20]) & set(ids[21]))
    assert len(b) == 1 and len(c) == 1 and ids[21][c.pop()] == 2  # one id for a word in every shard


def test_frequent_copies_count_once(documents):
    docs = documents((1, "x"), (2, "y")).crossJoin(documents((0, "")).sparkSession.range(4000)).select(
        (F.col("doc_id") * 10_000 + F.col("id")).alias("doc_id"), "text", F.lit("s").alias("source"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).limit(0)
    flags = filter_audit.flagged(docs, labels)
    assert flags.where("NOT contains(failed, 'E')").count() == 2 and flags.count() == 8000


# -- fill in the middle -----------------------------------------------------------

def brute_middle(doc, text, rate=100, spm=50):
    text = text or ""
    lines = text.split("\n")
    units = [u + "\n" for u in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    one, two, chance, order = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or chance % 100 >= rate:
        return len(units), "plain", None, None, text
    low, high = sorted((one % (len(units) + 1), two % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if order % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block, rate, spm", [(4096, 100, 50), (3, 100, 20), (1, 60, 50)])
def test_middles_equal_brute_force(spark, documents, odd, monkeypatch, block, rate, spm):
    monkeypatch.setattr(fill_in_middle.Layout.__init__, "__defaults__", (block,))
    rng = random.Random(block)
    rows = [(i, "".join(rng.choice(["\n", "é", "漢", "a", "\r\n", "😀", "<P", "S>", " "]) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(-5, "x<M>y\n"), (400, "\n"), (401, "\n" * 5000), (402, "no newline"), (403, "\x85a b\x0bc\n"), (404, "<S>"), (405, "<<S><")]
    docs = documents(*rows).unionByName(odd).withColumns({"form": F.lit(3), "output": F.lit("mine"), "schema": F.lit(1)}).repartition(3)
    made = fill_in_middle.transform(docs, rate=rate, spm=spm)
    assert set(made.columns) == {"doc_id", "lang", "source", "n_chars", "schema", "n", "form", "prefix_chars", "middle_chars", "output"}
    found = Counter(tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect())
    assert found == Counter((r.doc_id, *brute_middle(r.doc_id, r.text, rate, spm)) for r in docs.collect())
    back = Counter(tuple(r) for r in made.select("doc_id", fill_in_middle.restored(F.col("form"), F.col("output"))).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert fill_in_middle.transform(docs.limit(0)).count() == 0


def test_cut_at_every_line():
    rng = random.Random(3)
    text = "".join(rng.choice("ab\né漢") for _ in range(3000)).encode()
    for block in (1, 7, 64, 4096):
        layout, ends = fill_in_middle.Layout(text, block), [0]
        for i, b in enumerate(text):
            if b == 10:
                ends.append(i + 1)
        ends += [len(text)] if ends[-1] < len(text) else []
        assert layout.units == len(ends) - 1
        assert [layout.cut(k) for k in range(len(ends))] == [(e, len(text[:e].decode())) for e in ends]
