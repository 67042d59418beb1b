"""Order MinHash signatures against a plain version."""

from __future__ import annotations

import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from isobar.llm import order_minhash
from isobar.llm.order_minhash import KMER, NEAR, PICKED, PLACE, PLACE_BITS, SAMPLES

SEED = 42  # that of Spark's xxhash64


def hashed(data: bytes, seed: int = SEED) -> int:
    return xxhash.xxh64_intdigest(data, seed % 2**64)


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def plain_signature(text: str) -> list[int]:
    """All numbered k-mers are sorted, and each sample walks clockwise from its point."""
    if not text:
        return []
    seen, entries, n = {}, [], max(len(text) - KMER, 0) + 1
    for i in range(n):
        h = signed(hashed(text[i : i + KMER].encode("utf-32-be"))) >> PLACE_BITS
        o = seen[h] = seen.get(h, -1) + 1
        entries.append((h, o, i + 1))
    ring = []
    for h, o, place in entries:
        if o:
            turns = signed(hashed(struct.pack("<i", o), hashed(struct.pack("<q", h)))) % (SAMPLES - 1) + 1
            h = signed(((h % 2**64) ^ (turns << 58 - PLACE_BITS)) % 2 ** (64 - PLACE_BITS) << PLACE_BITS) >> PLACE_BITS
        ring.append((h, place))
    ring.sort()
    out = []
    for i in range(SAMPLES):
        point = (-(2**63) + i * 2**58) >> PLACE_BITS
        start = next((j for j, (h, _) in enumerate(ring) if h >= point), len(ring))
        picked = sorted((ring[(start + d) % len(ring)][::-1] for d in range(PICKED)))
        total = SEED
        for _, h in picked:
            total = hashed(struct.pack("<q", h), total)
        out.append(total & 0xFFFF)
    return out


def texts():
    rng = random.Random(2)
    return [
        "", "a", "short", "exactly sixteen!", "seventeen letters", "ab" * 40, "z" * 500, "漢字かな" * 30 + "\U0001F600é",
        " ".join(f"word{rng.randrange(30)}" for _ in range(300)), "".join(chr(rng.randrange(97, 123)) for _ in range(5000)),
        "".join(rng.choice("\U0001F600\U0001F680ab") for _ in range(3000)), "line of text that comes again\n" * 200,
        "y" * 4000, "x" * 4001, "ab" * 3000]


def test_signatures_equal_the_plain_version(documents):
    rows = list(enumerate(texts()))
    found = documents(*rows).select("doc_id", order_minhash.signature(F.col("text")).alias("s")).collect()
    assert {r.doc_id: r.s for r in found} == {i: plain_signature(t) for i, t in rows}
    assert len(rows[9][1]) > NEAR * SAMPLES and PLACE >= 5000  # some are thinned before they are sorted


@pytest.mark.parametrize("shift", [1, 5])
def test_edits_share_hashes_but_not_results(documents, shift):
    whole = texts()
    rows = [(i, t) for i, t in enumerate(whole[shift:] + whole[:shift])]
    found = order_minhash.fingerprinted_edits(documents(*rows)).collect()
    shown = lambda sig: "".join(f"{x:04x}" for x in sig)
    for r in found:
        text, following = rows[r.doc_id][1], rows[r.doc_id - 1][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b, c = plain_signature(text), plain_signature(edited), plain_signature(following)
        assert (r.fingerprint, r.edited_fingerprint) == (shown(a), shown(b)), (text[:20], following[:20])
        like = lambda x, y: float(len(x) == len(y)) if not x or not y else sum(p == q for p, q in zip(x, y)) / SAMPLES
        assert (r.near_edited, r.near_next) == (like(a, b), like(a, c))
