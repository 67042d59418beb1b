"""Order MinHash fingerprints: sketches that follow edit distance, with DataFrame functions only.

A text's k-mers start at every character, white space included; they are numbered by
occurrence, so repeats count. A k-mer's hash is its place on a ring for its first occurrence;
later ones turn it by a hashed number of sample steps. Sample i takes the first ``picked``
numbered k-mers clockwise of point i, which are the minimal ones under the i-th rotation of the
hash order. They are put back in text order and hashed as one tuple. Two texts are alike to the
share of samples in which they agree: that needs the same k-mers in the same order. The rotations
save one pass for each sample, and as turning keeps a k-mer's distance behind a point, only the
near ones of a long text have to be sorted, if every sample finds enough there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.llm.common import count_at_most, free_name, let, longs, pieces, quantiles

KMER = 16
PICKED = 2
SAMPLES = 64
PLACE_BITS = 29  # a text in four bytes a character is no longer than a JVM array
PLACE = (1 << PLACE_BITS) - 1
#: Numbered k-mers of a long text that are looked at first for each sample, on average; if any sample finds too few there, all are.
NEAR = 28
RANGE_BYTES = 64 << 20


def _hash(kmer: Column) -> Column:
    return F.shiftright(kmer, PLACE_BITS)


def _kmers(wide: Column, kmer: int, before: Column | int = 0) -> Column:
    """Hash and 1-based place (after ``before`` others) of every k-mer of a text in four bytes a character."""
    starts = F.sequence(F.lit(0), F.greatest((F.octet_length(wide) / 4).cast("int") - kmer, F.lit(0)))
    return F.transform(starts, lambda i: F.xxhash64(F.substring(wide, i * 4 + 1, F.lit(4 * kmer))).bitwiseAND(~PLACE).bitwiseOR(
        (i + 1 + before).cast("bigint")))


def _near(kmers: Column, samples: int) -> Column:
    """The k-mers close behind a point of the ring."""
    arc = 2**64 // samples
    reach = (F.lit(float(arc)) * (NEAR * samples) / F.size(kmers)).cast("bigint")
    close = let(reach, lambda l: F.filter(kmers, lambda x: x.bitwiseAND(arc - 1) < l))
    return close


def _numbered(kmers: Column, samples: int) -> Column:
    """Ascending ring places of (k-mer, occurrence), with the place in the text in their low bits."""
    bits = 64 - samples.bit_length() + 1

    def turned(x: Column, o: Column) -> Column:
        turns = F.pmod(F.xxhash64(_hash(x), o), F.lit(samples - 1)) + 1
        return x.bitwiseXOR(F.shiftleft(turns, bits))

    def by_runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (_hash(F.get(s, i)) != _hash(F.get(s, i - 1))))
        return let(starts, lambda st: F.flatten(F.transform(st, lambda i, j: F.transform(
            F.slice(s, i + 1, F.coalesce(F.get(st, j + 1), n) - i), lambda x, o: turned(x, o + 1)))))

    def of_sorted(s: Column) -> Column:
        again = F.filter(s, lambda x, i: (i > 0) & (_hash(x) == _hash(F.get(s, i - 1))))
        return let(again, lambda r: F.when(F.size(r) == 0, s).otherwise(F.sort_array(F.concat(
            F.filter(s, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(s, i - 1)))), by_runs(r)))))

    return let(F.sort_array(kmers), of_sorted)


def _signed(kmers: Column, samples: int, picked: int) -> Column:
    """Tuple hashes of a text's k-mers, from :func:`_kmers`."""
    bits = 64 - samples.bit_length() + 1
    arc = lambda x: F.shiftright(x, bits)

    def of_numbered(t: Column) -> Column:
        n = F.size(t)
        points = longs([-(2**63) + i * (2**64 // samples) for i in range(samples)])  # their place bits are 0
        ring = F.sort_array(F.concat(t, points))
        at = let(ring, lambda u: F.filter(F.sequence(F.lit(0), F.size(u) - 1), lambda i: F.get(u, i).bitwiseAND(PLACE) == 0))
        entry = lambda x: F.struct(x.bitwiseAND(PLACE).alias("place"), _hash(x).alias("kmer"))
        chosen = lambda p, i: F.array(*(entry(F.get(t, (p - i + d) % n)) for d in range(picked)))
        return F.transform(at, lambda p, i: F.xxhash64(F.transform(
            F.sort_array(chosen(p, i)), lambda e: e.kmer)).bitwiseAND(0xFFFF).cast("int"))

    # No sample takes more than the first ones behind its point, or behind a later point.
    first = lambda t: F.filter(t, lambda x, i: (i < picked) | (arc(x) != arc(F.get(t, i - picked))))
    of_all = let(_numbered(kmers, samples), first)
    of_near = let(let(_numbered(_near(kmers, samples), samples), first), lambda f: F.when(F.size(f) == picked * samples, f))
    return let(F.when(F.size(kmers) <= NEAR * samples, of_all).otherwise(F.coalesce(of_near, of_all)), of_numbered)


def _wide(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-32")  # four bytes a character, so any offset is found at once


NONE = "array<int>"


def signature(text: Column, samples: int = SAMPLES, kmer: int = KMER, picked: int = PICKED) -> Column:
    """``samples`` (a power of two) 16-bit tuple hashes as array<int>; empty for an empty text. Null counts as empty.

    A text shorter than a k-mer counts as one.
    """
    return let(_wide(text), lambda b: F.when(F.octet_length(b) == 0, F.array().cast(NONE)).otherwise(
        let(_kmers(b, kmer), lambda k: _signed(k, samples, picked))))


def signatures_of_edit(text: Column, kept: Column, added: Column, samples: int = SAMPLES, kmer: int = KMER, picked: int = PICKED) -> Column:
    """Struct of ``text``'s signature and of that of its first ``kept`` characters with ``added`` behind them.

    K-mers that lie in the kept part are hashed once for both.
    """
    shared = F.greatest(kept - (kmer - 1), F.lit(0))  # k-mers in the kept part alone
    edited = kept + F.length(added)

    def of_kmers(k: Column) -> Column:
        seam = F.concat(F.substring(text, shared + 1, kept - shared), added)
        rest = F.when((edited < kmer) | (edited - shared >= kmer), let(_wide(seam), lambda b: _kmers(b, kmer, shared))).otherwise(
            F.array().cast("array<bigint>"))
        whole = lambda: F.concat(F.slice(k, F.lit(1), F.when(edited < kmer, F.lit(0)).otherwise(shared)), rest)
        return F.struct(
            _signed(k, samples, picked).alias("signature"),
            F.when(edited == 0, F.array().cast(NONE)).otherwise(let(whole(), lambda e: _signed(e, samples, picked))).alias("edited_signature"))

    none = F.array().cast(NONE)
    empty = F.struct(none.alias("signature"), let(_wide(added), lambda b: F.when(F.octet_length(b) == 0, none).otherwise(
        let(_kmers(b, kmer), lambda k: _signed(k, samples, picked)))).alias("edited_signature"))
    return F.when(F.length(text) == 0, empty).otherwise(let(let(_wide(text), lambda b: _kmers(b, kmer)), of_kmers))


def fingerprint(sig: Column) -> Column:
    """Four hexadecimal digits for each sample."""
    return F.concat_ws("", F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples in which two signatures agree; two empty ones are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(
        same / F.lit(float(samples)))


def with_next(docs: DataFrame, columns: list[str], ties: list[str],
              then: Callable[[DataFrame], DataFrame] = lambda df: df, made: list[str] | None = None) -> DataFrame:
    """Add ``next_<column>`` of the following row in descending doc_id; after the last row comes the first.

    Null doc_ids come last, equal ones are ordered by the ``ties``. Rows are dealt out by ranges of
    doc_id, each row once; the first of a range also goes to the range before it. ``then`` adds
    columns to the dealt rows, and the following row's ``made`` ones are added too, without another shuffle.
    """
    made = made or []
    flipped, at, guest, one = (free_name(docs, n) for n in ("_flipped", "_range", "_guest", "_one"))
    keyed = docs.withColumn(flipped, F.bitwise_not(F.coalesce(F.col("doc_id"), F.lit(-(2**63)))))  # nulls last
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splits = quantiles(keyed.select(flipped), flipped, max(pieces(docs.sparkSession), size // RANGE_BYTES))
    keyed = keyed.withColumn(at, count_at_most(splits, F.col(flipped)))
    heads = {r[0]: r[1] for r in keyed.groupBy(at).agg(F.min(flipped)).collect()}  # one row for each range
    filled = sorted(heads)
    if not filled:
        led = then(keyed.drop(flipped, at).withColumns({f"next_{c}": F.col(c) for c in columns}))
        return led.withColumns({f"next_{c}": F.col(c) for c in made})
    first = longs([heads.get(i, 0) for i in range(len(splits) + 1)])
    back = dict(zip(filled, filled[-1:] + filled[:-1]))
    before = longs([back.get(i, 0) for i in range(len(splits) + 1)])
    is_head = F.get(first, F.col(at)) == F.col(flipped)
    places = lambda: F.when(is_head, F.array(
        F.struct(F.col(at).cast("bigint").alias(at), F.lit(0).alias(guest)),
        F.struct(F.get(before, F.col(at)).alias(at), F.lit(1).alias(guest)),
    )).otherwise(F.array(F.struct(F.col(at).cast("bigint").alias(at), F.lit(0).alias(guest))))
    dealt = keyed.withColumn(one, F.explode(places())).drop(at).select("*", f"{one}.*").drop(one)
    order = Window.partitionBy(at).orderBy(guest, flipped, *ties)
    led = then(dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}))
    if made:
        led = led.withColumns({f"next_{c}": F.lead(c).over(order) for c in made})
    return led.where(F.col(guest) == 0).drop(flipped, at, guest)


def fingerprinted_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints and their likeness, and that to the next document.

    The edited text has its last third replaced by the start of the next document. Null texts count
    as empty and have empty fingerprints; repeated rows are rows of their own, next to each other; one
    row is its own next document; no rows give none. Other columns are ignored.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")

    def sign(rows: DataFrame) -> DataFrame:
        added = F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), F.col("_third"))
        cut = rows.withColumn("_third", third).withColumns({"_added": added, "_kept": F.length("text") - F.col("_third")})
        signed = cut.withColumn("_signed", signatures_of_edit(F.col("text"), F.col("_kept"), F.col("_added")))
        return signed.withColumns({
            "n_chars": F.length("text").cast("bigint"),
            "edited_sha256": F.sha2(F.concat(F.substring(F.col("text"), F.lit(1), F.col("_kept")), F.col("_added")), 256),
            "signature": F.col("_signed.signature"), "edited_signature": F.col("_signed.edited_signature"),
        }).drop("next_text", "_third", "_added", "_kept", "_signed")

    return with_next(text, ["text"], ["text"], sign, ["signature"]).select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("signature")).alias("fingerprint"), fingerprint(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
