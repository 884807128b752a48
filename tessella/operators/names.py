"""Names in texts, and names that are nearly alike."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import normalised
from tessella.session import ship


def _pieces(length: Column, at: Column, number: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of piece ``at`` (from 0) of ``number`` nearly equal pieces of a text."""
    start = F.floor(at * length / number)
    return start + 1, F.floor((at + 1) * length / number) - start


def _edits(first: Column, second: Column, cutoff: float) -> Column:
    """Insertions and deletions that turn texts of these lengths into each other at most, if the share of matching characters is ``cutoff`` or more."""
    return F.floor((1 - cutoff) * (first + second) + 1e-9)


def _letters(text: str) -> Column:
    """64 bits about a text's characters: whether one of each of 32 kinds is there, and whether two are. One insertion or deletion changes one bit at most."""
    bit = "shiftleft(1L, 2 * (ascii(c) % 32))"
    return F.expr(f"aggregate(filter(split({text}, ''), c -> c <> ''), 0L, (m, c) -> m | if((m & {bit}) = 0, {bit}, shiftleft({bit}, 1)))")


def close_matches(tokens: DataFrame, names: DataFrame, token: str, name: str, n: int = 2, cutoff: float = 0.9) -> DataFrame:
    """(token, name, ratio, rank): the ``n`` names most like each token, of those whose ratio of matching blocks is ``cutoff`` or more; of equal ratios the later name.

    The ratio is twice the characters in matching blocks (the longest one, then the longest on either side of it, and so on) over all characters. Matching blocks are a common
    subsequence, so texts of a ratio are few insertions and deletions apart; of two more pieces of the name than that, two at least stand unbroken in the token, shifted by as many places at most. Tokens
    and names therefore meet by equal pieces, number of the piece and lengths, where bits about their characters don't differ in more places than that, and pairs with two such pieces are kept; characters that both have bound the ratio next, and only what is left is matched block by block. No pair is lost and no product is made.

    Null and repeated texts count once; empty ones match nothing. A ratio of two thirds or less would need more pieces than characters and is refused.
    """
    if not 2 / 3 < cutoff <= 1:
        raise ValueError("cutoff must be above two thirds")
    ship(tokens.sparkSession)
    t = tokens.select(F.col(token).alias("_t")).filter("_t <> ''").distinct().withColumns({"_tl": F.length("_t"), "_tb": _letters("_t")})
    w = names.select(F.col(name).alias("_w")).filter("_w <> ''").distinct().withColumns({"_wl": F.length("_w"), "_wb": _letters("_w")})
    # Few bytes become very many rows, so their parts are not put together by bytes.
    width = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t, w = t.repartition(width), w.repartition(width)
    # A name is filed for every length that a partner may have.
    ratio = cutoff / (2 - cutoff)
    span = lambda c: F.sequence(F.ceil(F.col(c) * ratio - 1e-9), F.floor(F.col(c) / ratio + 1e-9))
    filed = w.withColumn("_tl", F.explode(span("_wl"))).withColumn("_e", _edits(F.col("_tl"), F.col("_wl"), cutoff))
    filed = filed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_e") + 1)))
    start, length = _pieces(F.col("_wl"), F.col("_k"), F.col("_e") + 2)
    filed = filed.withColumn("_p", F.col("_w").substr(start.cast("int"), length.cast("int"))).filter("_p <> ''").select("_w", "_wb", "_e", F.col("_wl").cast("bigint"), "_tl", "_k", "_p", F.least(F.col("_wl") - F.col("_e"), F.lit(2)).alias("_least"))
    asked = t.withColumn("_tl", F.col("_tl").cast("bigint")).withColumn("_wl", F.explode(span("_tl"))).withColumn("_e", _edits(F.col("_tl"), F.col("_wl"), cutoff))
    asked = asked.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_e") + 1)))
    start, length = _pieces(F.col("_wl"), F.col("_k"), F.col("_e") + 2)
    asked = asked.withColumns({"_s": start, "_n": length}).filter("_n BETWEEN 1 AND _tl")
    first, last = F.greatest(F.lit(1).cast("bigint"), F.col("_s") - F.col("_e")), F.greatest(F.lit(1).cast("bigint"), F.least(F.col("_tl") - F.col("_n") + 1, F.col("_s") + F.col("_e")))
    shifted = F.transform(F.sequence(first, last), lambda at: F.col("_t").substr(at.cast("int"), F.col("_n").cast("int")))
    asked = asked.select("_t", "_tb", "_tl", "_wl", "_k", F.explode(F.array_distinct(shifted)).alias("_p"))
    # A name with fewer characters than pieces has an empty one, which nothing can break.
    pairs = asked.join(filed, ["_tl", "_wl", "_k", "_p"]).filter("bit_count(_tb ^ _wb) <= _e").groupBy("_t", "_w").agg(F.countDistinct("_k").alias("_met"), F.first("_least").alias("_least")).filter("_met >= _least").select("_t", "_w")

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ratios = []
            for t, w in zip(rows["_t"], rows["_w"], strict=True):
                match = SequenceMatcher(None, w, t)
                ratios.append(match.ratio() if match.quick_ratio() >= cutoff else 0.0)
            yield rows.assign(ratio=ratios)

    found = pairs.mapInPandas(measured, "_t string, _w string, ratio double").filter(F.col("ratio") >= cutoff)
    ranked = found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY _t ORDER BY ratio DESC, _w DESC)")).filter(F.col("rank") <= n)
    return ranked.select(F.col("_t").alias(token), F.col("_w").alias(name), "ratio", "rank")


#: Bits of a filter of names, a multiple of those of Spark's bitmaps.
FILTER = 2**22
_WORD = re.compile(r"\w+")


def _filter(df: DataFrame, text: str) -> dict[int, bytes]:
    """The bits of all texts' hashes, in Spark's bitmaps of 32,768 bits by number: half a MB at most, whatever the number of texts."""
    bit = F.crc32(F.col(text).cast("binary")) % FILTER
    rows = df.select(bit.alias("b")).groupBy(F.floor(F.col("b") / 32768).alias("n")).agg(F.bitmap_construct_agg(F.col("b") % 32768).alias("bits")).collect()
    return {r.n: bytes(r.bits) for r in rows}


def _passes(found: dict[int, bytes], text: str) -> bool:
    bit = crc32(text.encode()) % FILTER
    bits = found.get(bit >> 15)
    return bits is not None and bool(bits[(bit & 32767) >> 3] >> (bit & 7) & 1)


def dictionary_matches(docs: DataFrame, id_col: str, text_col: str, names: DataFrame) -> DataFrame:
    """(id, name, start, end) of the dictionary's names in normalised texts: from left to right the longest at each place, whole words only, none inside another.

    ``names`` has one column; names are compared word by word, in normal form, and come back as their words with blanks between. The dictionary may be of any size: where a name
    begins with a word, what a filter of ``FILTER`` bits of the names' hashes lets through becomes a row, and these are joined with the names, so a collision adds nothing. A larger
    dictionary lets more through, but loses nothing. Repeated rows are matched each for itself; null and empty texts and names match nothing.
    """
    ship(docs.sparkSession)
    known = names.select(F.regexp_extract_all(normalised(F.col(names.columns[0])), F.lit(r"(?U)(\w+)"), F.lit(1)).alias("n")).filter("size(n) > 0").select(F.size("n").alias("words"), F.element_at("n", 1).alias("head"), F.array_join("n", " ").alias("name")).distinct()
    sizes = sorted(r.words for r in known.select("words").distinct().collect())
    heads, whole = _filter(known, "head"), _filter(known, "name")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each place and number of words at which a name may be."""
        columns, begins = ("_row", "_id", "k", "words", "name", "start", "end"), {}
        for batch in batches:
            rows: list[tuple] = []
            for row, key, text in zip(batch["_row"], batch["_id"], batch["_text"], strict=True):
                words = _WORD.findall(text)
                if len(begins) > 200_000:
                    begins.clear()
                for w in set(words):
                    if w not in begins:
                        begins[w] = _passes(heads, w)
                if not any(begins[w] for w in words):
                    continue
                spans = None
                for k, w in enumerate(words):
                    if begins[w]:
                        for n in sizes:
                            if k + n > len(words):
                                break
                            name = " ".join(words[k : k + n])
                            if _passes(whole, name):
                                spans = spans or [m.span() for m in _WORD.finditer(text)]
                                rows.append((row, key, k, n, name, spans[k][0], spans[k + n - 1][1]))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    texts = docs.select(F.col(id_col).cast("string").alias("_id"), F.monotonically_increasing_id().alias("_row"), normalised(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    hits = texts.mapInPandas(split, "_row bigint, _id string, k int, words int, name string, start int, end int").join(known.select("name", "words"), ["name", "words"])
    ordered = F.array_sort(F.collect_list(F.struct("k", (-F.col("words")).alias("less"), "name", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))))
    kept = F.expr("aggregate(hits, named_struct('next', 0, 'kept', filter(hits, h -> false)), (s, h) -> if(h.k < s.next, s, named_struct('next', h.k - h.less, 'kept', array_append(s.kept, h)))).kept")
    found = hits.groupBy("_row", "_id").agg(ordered.alias("hits")).select("_id", F.explode(kept).alias("h"))
    return found.select(F.col("_id").cast(docs.schema[id_col].dataType).alias("id"), "h.name", "h.start", "h.end")
