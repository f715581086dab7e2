"""Phrase collocation mining with prefix- and suffix-ordered count streams.

A phrase is a run of 2 to ``Params.longest`` words inside one piece of text.
Only the window of words that starts at a position is counted; the counts of
all shorter phrases are sums over the prefixes of the windows, which lie
together in prefix order. A walk over the stream in that order keeps the
prefixes of the current phrase on a stack and so reads the count of every left
part, and the walk in suffix order that of every right part; neither looks
anything up by hash.

Words and pairs that occur less often than the threshold cannot lie in a
candidate, so windows end there. They are recognised by hash in bit tables of a
fixed size, which may let some pass that are rare, never the other way round:
results are exact, and a larger corpus only passes more.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _powers as powers
from .common import mix64, stored

#: FIXED VALUES: the contract's characters that end a piece and that separate words.
PIECE_END = "[.,;:!?\\n\\x0B\\f\\r]"
BLANK = "[ \\t]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Params:
    """``least``: occurrences of a candidate; ``longest``: its words at most;
    ``top``: reported per language; ``bits``: size of each bit table as a power
    of two (2^24 bits are 2 MB, sent once to each executor)."""

    least: int = 100
    longest: int = 5
    top: int = 2000
    bits: int = 24


def pieces(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, w): the words of every piece that has any; null languages are
    ``und``, null texts empty. Only A-Z are lower-cased."""
    body = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return (docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                        F.explode(F.split(body, PIECE_END)).alias("piece"))
            .select("lang", F.filter(F.split("piece", BLANK), lambda x: x != "").alias("w"))
            .where(F.size("w") > 0))


_WORD, _BLANK_BYTE, _END_BYTE = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = _BLANK_BYTE
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _END_BYTE
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
#: Bytes of text hashed at once.
CHUNK = 1 << 21
#: The windows of a pair that is more than one in so many words are dealt by three words.
HOT = 1024


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _chunks(langs: list, texts: list) -> Iterator[tuple[str, bytes]]:
    """The texts of each language as lower-cased bytes, joined by piece ends and
    cut at piece ends into chunks of about ``CHUNK`` bytes."""
    joined: dict[str, list] = {}
    for lang, text in zip(langs, texts):
        if text:
            joined.setdefault("und" if lang is None else lang, []).append(text)
    for lang, parts in joined.items():
        raw = _LOWERED[np.frombuffer("\n".join(parts).encode(), np.uint8)]
        ends = np.flatnonzero(_KIND[raw] == _END_BYTE)
        at = 0
        while at < len(raw):
            i = np.searchsorted(ends, at + CHUNK)
            to = int(ends[i]) + 1 if i < len(ends) else len(raw)
            yield lang, raw[at:to].tobytes()
            at = to


def _hashed(lang: str, raw: bytes) -> tuple[np.ndarray, ...]:
    """(hashes, starts, ends, piece numbers) of the words of a chunk."""
    points = np.frombuffer(raw, np.uint8)
    kind = _KIND[points]
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = kind == _WORD
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[0::2], turns[1::2]
    up, down = powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:len(points)], out=sums[1:])
    hashes = mix64(mix64((sums[ends] - sums[starts]) * down[starts]) + _lang_hash(lang))
    return hashes, starts, ends, np.cumsum(kind == _END_BYTE)[starts]


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix64(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


def _set(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slots = hashes & np.uint64((1 << bits) - 1)
    return (table[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _usual_pairs(lang: str, raw: bytes, usual: np.ndarray, bits: int):
    hashes, starts, ends, piece = _hashed(lang, raw)
    known = _set(usual, hashes, bits)
    return _pairs(hashes), known[:-1] & known[1:] & (piece[:-1] == piece[1:]), starts, ends


def _bit_table(slots: DataFrame, bits: int) -> np.ndarray:
    """A table of 2^``bits`` bits with the ``slot`` values of ``slots`` set. The
    driver receives at most 2^(bits - 15) blocks of 4 KB, whatever the data."""
    blocks = (slots.groupBy(F.bitmap_bucket_number("slot").alias("block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("x")).collect())
    table = np.zeros(max(1 << 12, 1 << (bits - 3)), np.uint8)
    for r in blocks:  # bucket 0 holds value 0 alone, bucket b the values up to b * 32768
        block = np.frombuffer(r["x"], np.uint8)
        at = (r["block"] - 1) * len(block)
        table[at:at + len(block)] = block
    return table


def window_counts(docs: DataFrame, p: Params, text: str = "text", lang: str = "lang") -> tuple[DataFrame, ...]:
    """Three tables: (lang, word, count) of all words; of the words that reach
    the threshold; and (lang, w, c, hot) of the windows of 2 to ``longest`` words
    without a rare word or pair, counted in parts. A window is its words, each
    with a line end behind it (which no word holds), so that the windows of a
    prefix lie together in byte order; ``hot`` marks those of a very common
    first pair."""
    context, bits, longest = docs.sparkSession.sparkContext, p.bits, p.longest
    body = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    words = stored(pieces(docs, text, lang).select("lang", F.explode("w").alias("word"))
                   .groupBy("lang", "word").count(), "words")
    usual = words.where(F.col("count") >= p.least)

    def word_slots(batches):
        for batch in batches:
            slots = [int(_hashed(a, b.encode())[0][0] & np.uint64((1 << bits) - 1)) + 1
                     for a, b in zip(batch["lang"].to_pylist(), batch["word"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slots, pa.int64())})

    known = context.broadcast(_bit_table(usual.select("lang", "word").mapInArrow(word_slots, "slot bigint"), bits))

    def pairs(batches):
        for batch in batches:
            for a, raw in _chunks(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                pair, good, _, _ = _usual_pairs(a, raw, known.value, bits)
                found, c = np.unique(pair[good].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_pydict({"pair": pa.array(found), "c": pa.array(c.astype(np.int64))})

    slot = F.col("pair").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    often = stored(body.mapInArrow(pairs, "pair bigint, c bigint").groupBy("pair").agg(F.sum("c").alias("c"))
                   .where(F.col("c") >= p.least), "pairs")
    linked = context.broadcast(_bit_table(often.select(slot.alias("slot")), bits))
    # Pairs with more than 1/HOT of all words: fewer than HOT.
    n = words.agg(F.sum("count")).first()[0] or 0
    hot = np.array([r["pair"] for r in often.where(F.col("c") * HOT > n).select("pair").collect()], np.int64)

    def windows(batches):
        for batch in batches:
            for a, raw in _chunks(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                pair, good, starts, ends = _usual_pairs(a, raw, known.value, bits)
                link = np.zeros(len(pair) + longest, np.int64)
                link[:len(pair)] = good & _set(linked.value, pair, bits)
                more = np.zeros(len(pair), np.int64)  # words after the first, as far as the links reach
                for i in reversed(range(longest - 1)):
                    more = link[i:i + len(pair)] * (1 + more)
                at = np.flatnonzero(more)
                split = np.isin(pair[at].view(np.int64), hot)
                found = Counter((raw[x:y], z) for x, y, z in zip(starts[at].tolist(), ends[at + more[at]].tolist(), split.tolist()))
                # Blanks differ between occurrences of one window; the sums outside take care of it.
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([a] * len(found), pa.string()),
                    "w": pa.array([b"\n".join(x.split()) + b"\n" for x, _ in found], pa.string()),
                    "c": pa.array(list(found.values()), pa.int64()),
                    "hot": pa.array([z for _, z in found], pa.bool_())})

    return words, usual, body.mapInArrow(windows, "lang string, w string, c bigint, hot boolean")


def _ordered(stream: DataFrame) -> DataFrame:
    """``stream`` in the order of (lang, w), cut into ranges of that order, so
    that no word, however common, is more than a range."""
    return stream.repartitionByRange("lang", "w").sortWithinPartitions("lang", "w")


_SUMS = "lang string, w array<string>, f bigint"


def _prefix_sums(least: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the window counts over every prefix of two words or more, in
        one pass over the sorted stream. Only a hot pair comes in parts, one from
        each task that has windows of it; other prefixes are whole, and those
        below the threshold go no further."""
        lang, stack, out = None, [], []  # stack[i]: [first i + 2 words, sum, whether a part]

        def close(keep: int) -> None:
            while len(stack) > keep:
                w, f, part = stack.pop()
                if part or f >= least:
                    out.append((lang, w.split("\n")[:-1], f))

        for batch in batches:
            for one, w, c, hot in zip(*[batch[x].to_pylist() for x in ("lang", "w", "c", "hot")]):
                keep = 0
                if one == lang:
                    while keep < len(stack) and w.startswith(stack[keep][0]):
                        keep += 1
                close(keep)
                lang = one
                words = w.split("\n")[:-1]
                for size in range(len(stack) + 2, len(words) + 1):
                    stack.append(["\n".join(words[:size]) + "\n", 0, hot and size == 2])
                for entry in stack:
                    entry[1] += c
            yield _rows(out, _SUMS)
            out.clear()
        close(0)
        yield _rows(out, _SUMS)
    return walk


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
          "array<bigint>": pa.list_(pa.int64())}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [pa.field(c.split()[0], _ARROW[c.split()[1]]) for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def phrase_counts(docs: DataFrame, p: Params = Params(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, w, f): the empty phrase with all word occurrences of the language,
    and every word and phrase that occurs ``least`` times or more."""
    words, usual, windows = window_counts(docs, p, text, lang)
    first = lambda n: F.substring_index("w", "\n", n)
    sums = (windows.repartition("lang", F.when(F.col("hot"), first(3)).otherwise(first(2)))
            .sortWithinPartitions("lang", "w").mapInArrow(_prefix_sums(p.least), _SUMS)
            .groupBy("lang", "w").agg(F.sum("f").alias("f")).where(F.col("f") >= p.least))
    nothing = F.array().cast("array<string>")
    return (words.groupBy("lang").agg(F.sum("count").alias("f")).select("lang", nothing.alias("w"), "f")
            .unionByName(usual.select("lang", F.array("word").alias("w"), F.col("count").alias("f")))
            .unionByName(sums))


_WALKED = "lang string, w array<string>, f bigint, above array<bigint>, whole boolean, more array<bigint>, gone boolean"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each phrase with ``above``, the counts of its shorter prefixes from the
    empty one on (null where the prefix lies in an earlier range; ``whole`` says
    that there is none), and ``gone``, whether a phrase one word longer in this
    range is as frequent."""
    lang, stack, out = None, [], []  # stack: [words, count, above, more, gone] of open phrases

    def close(keep: int) -> None:
        while len(stack) > keep:
            w, f, above, more, gone = stack.pop()
            out.append((lang, w, f, above, None not in above, more, gone))

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("lang", "w", "f", "more", "gone")]
        for one, w, f, more, gone in zip(*columns):
            if one != lang:
                close(0)
                lang = one
            while stack and w[:len(stack[-1][0])] != stack[-1][0]:
                close(len(stack) - 1)
            above = [None] * len(w)
            for entry in stack:
                above[len(entry[0])] = entry[1]
            if stack and len(stack[-1][0]) == len(w) - 1 > 1 and 100 * f >= 100 * stack[-1][1]:
                stack[-1][4] = True
            stack.append([w, f, above, more, gone])
        yield _rows(out, _WALKED)
        out.clear()
    close(0)
    yield _rows(out, _WALKED)


def _walked(stream: DataFrame, name: str) -> DataFrame:
    """``stream`` (lang, w, f, more, gone) with ``above`` complete. What a range
    lacks are prefixes of its first phrase: at most one of each length for every
    range, which bounds the broadcast tables."""
    done = stored(_ordered(stream).mapInArrow(_walk, _WALKED), name)
    torn = done.where(~F.col("whole"))
    steps = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("above", i).isNull())
    sought = (torn.select("lang", F.explode(F.transform(steps, lambda i: F.slice("w", 1, i))).alias("w")).distinct())
    found = stored(stream.select("lang", "w", "f").join(F.broadcast(sought), ["lang", "w"], "left_semi"), f"{name}-borders")
    longest = Params.longest
    for i in range(longest):
        one = found.where(F.size("w") == i).select("lang", F.col("w").alias("_w"), F.col("f").alias(f"_f{i}"))
        torn = (torn.withColumn("_w", F.when(F.size("w") > i, F.slice("w", 1, i)))
                .join(F.broadcast(one), ["lang", "_w"], "left").drop("_w"))
    filled = F.transform("above", lambda x, i: F.coalesce(x, F.get(F.array(*[f"_f{j}" for j in range(longest)]), i)))
    torn = torn.withColumn("above", filled).drop(*[f"_f{j}" for j in range(longest)])
    # Phrases of an earlier range that one of this range extends and equals.
    last = F.get("above", F.size("w") - 1)
    equalled = (torn.where((F.size("w") > 2) & (100 * F.col("f") >= 100 * last))
                .select("lang", F.slice("w", 1, F.size("w") - 1).alias("w"))
                .join(F.broadcast(sought), ["lang", "w"], "left_semi").distinct().withColumn("_gone", F.lit(True)))
    return (done.where("whole").unionByName(torn).join(F.broadcast(equalled), ["lang", "w"], "left")
            .withColumn("gone", F.col("gone") | F.coalesce("_gone", F.lit(False))).drop("_gone", "whole"))


def collocations(docs: DataFrame, p: Params = Params(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score,
    cut), all by the contract's rules.

    Null and empty texts have no words; a null language is ``und``; repeated rows
    count each time; ties go by count and then by the phrase; a table without
    words gives no rows. A text of any length is cut into pieces where it is read.
    Only the two columns named are read, so others may have any names.
    """
    if p.longest > Params.longest:
        raise ValueError(f"phrases have {Params.longest} words at most")
    counts = stored(phrase_counts(docs, p, text, lang), "phrases")
    no = F.array().cast("array<bigint>")
    left = _walked(counts.withColumn("more", no).withColumn("gone", F.lit(False)), "prefix-order")
    both = _walked(stored(left.select("lang", F.reverse("w").alias("w"), "f", F.col("above").alias("more"), "gone"),
                          "suffix-order-input"), "suffix-order")
    kept = both.where((F.size("w") > 1) & ~F.col("gone"))
    # more: counts of the prefixes, above: of the suffixes, from the empty phrase on.
    exact = lambda x: x.cast("decimal(38,0)")
    size, n = F.size("w"), F.get("more", 0)
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        F.expr("0L").alias("score"), k.alias("cut"), F.get("more", k).alias("l"),
        F.get("above", size - k).alias("r")))
    scored = (kept.select("lang", F.array_join(F.reverse("w"), " ").alias("phrase"), F.col("f").alias("a"),
                          n.alias("n"), F.explode(cuts).alias("c"))
              .select("lang", "phrase", "a", "n", F.struct(
                  F.call_function("div", exact(F.lit(1000)) * exact(F.col("a")) * exact(F.col("n")),
                                  exact(F.col("c.l")) * exact(F.col("c.r"))).alias("score"),
                  "c.cut", "c.l", "c.r").alias("c"))
              .groupBy("lang", "phrase", "a", "n").agg(F.min("c").alias("c"))
              .select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score", "c.cut"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    # The first of every language among the first of its 64 parts.
    part = Window.partitionBy("lang", salt).orderBy(*best)
    whole = Window.partitionBy("lang").orderBy(*best)
    return (scored.withColumn("_i", F.row_number().over(part)).where(F.col("_i") <= p.top)
            .withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= p.top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"))
