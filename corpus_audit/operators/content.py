"""Generated content against its sources: overlap, verbatim runs, coverage, bias, page reach."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_audit.findings import as_findings, rule_findings
from corpus_audit.functions import text as tx
from corpus_audit.scale import BROADCAST_LIMIT_BYTES, estimated_bytes
from corpus_audit.session import written

# Thresholds, vocabularies and section names of the content contract.
NGRAM_SIZE = 8
OVERLAP_LIMIT = 0.2
VERBATIM_WINDOW = 201
MIN_CHARS = {"explain": 120, "memorize": 80, "drill": 40, "exam_strategy": 40}
BLOCK_KINDS = ["explain", "memorize", "drill", "exam_strategy"]
SOURCE_KINDS = ["ai_generated", "official_sample"]
STAGES = ["入门", "精读", "刷题", "冲刺", "复盘"]
EXPLAIN_HEADINGS = ["### 要点梳理", "### 易错点"]
MEMORY_WORDS = ["记忆", "口诀", "对比", "联想", "串联", "谐音", "关键词", "顺口溜"]
PREFERRED_TYPE = {"识记": "单项选择题", "领会": "简答题", "应用": "材料题"}
GENERATOR_KEYS = ["backend", "model", "prompt_id", "prompt_version", "generated_at"]
MAX_SAMPLE_CHARS = 200
MAX_QUOTE_LINE_CHARS = 80
QUESTION_LIKE = r"选择题|填空题|简答题|材料题|下列.*正确"
MIN_ANSWERS = 10
SHARE_LIMITS = {"single_choice": 40, "judgement": 80}
FILLER_LINE = r"^[A-D]\s*项[^，。：；]{0,6}(与事实(不符|相反)|表述不准确|不完整|与本条要点无关|与史实不符)。?$"
AI_CREDIT = r"AI\s*(?:辅助|初稿|原创|撰写|整理|生成)"
NO_AI_CLAIM = (
    r"(?:零|无|没有|不含|不包含|不产出|不生成|未产出|未生成)\s*(?:任何)?\s*AI\s*"
    r"(?:内容|产物|文字|文本|元素|区块)"
)
MISSING_CHAPTER_CLAIM = (
    r"缺\s*[少了]?\s*第\s*[\d\-–—]+\s*章|第\s*[\d\-–—]+\s*章\s*缺\s*[失少]"
    r"|第\s*[\d\-–—]+\s*章\s*未\s*(?:收录|覆盖|包含|列出|纳入)|考纲\s*缺\s*章"
)

# Characters per slice when a text is exploded into windows; bounds one row's array, not the result.
SLICE_CHARS = 16384


def text_windows(
    df: DataFrame, keep: list[str], text: Column, size: int, step_positions: bool = False
) -> DataFrame:
    """Every ``size``-character window of a text, one row each (``gram``), with ``pos`` when asked for.

    A lookahead capture makes the regex engine emit overlapping windows in one linear scan, one code point
    per step.  Long texts are first cut into slices that overlap by ``size - 1`` characters, so no row ever
    carries an array larger than one slice.
    """
    overlap = size - 1
    slices = F.regexp_extract_all(
        text, F.lit(rf"(?s)(?=(.{{1,{SLICE_CHARS + overlap}}}+)).{{1,{SLICE_CHARS}}}+"), F.lit(1)
    )
    grams = F.regexp_extract_all(F.col("_slice"), F.lit(rf"(?s)(?=(.{{{size}}})).{{1}}"), F.lit(1))
    if not step_positions:
        return df.select(*keep, F.explode(slices).alias("_slice")).select(*keep, F.explode(grams).alias("gram"))
    return (
        df.select(*keep, F.posexplode(slices).alias("_at", "_slice"))
        .select(*keep, "_at", F.posexplode(grams).alias("_in", "gram"))
        .select(*keep, (F.col("_at") * SLICE_CHARS + F.col("_in") + 1).alias("pos"), "gram")
    )


#: bits of the gram filter for each gram the source may hold, words of a filter row, positions a gram sets in its word
FILTER_BITS, FILTER_WORDS, FILTER_HITS = 16, 1024, 4
#: share of grams outside the source that the filter lets pass when it is as full as it was laid out for
FILTER_FALSE = 0.01


def _filter_place(keys: list[str], rows: int) -> dict[str, Column]:
    """Row of the filter, word in it, and the bits of the word for a gram: parts of one 64-bit hash."""
    h = F.xxhash64(*keys, "gram")
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 10 + 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(FILTER_HITS)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    segment = F.pmod(F.shiftrightunsigned(h, 34), F.lit(rows))
    return {"_segment": segment, "_word": h.bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int"), "_mask": mask}


def gram_filter(grams: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """A Bloom filter of ``grams(keys, gram)`` as ``rows`` rows (_segment, _words), 8 KiB each whatever the grams are.

    The bits of a word are or-ed as a mergeable aggregate, so a task sends each word it touches once.  A row gathers
    a fixed number of words.
    """
    place = _filter_place(keys, rows)
    set_bits = grams.select(*[c.alias(n) for n, c in place.items()])
    every = grams.sparkSession.range(rows * FILTER_WORDS).select(
        F.expr(f"id div {FILTER_WORDS}").alias("_segment"), (F.col("id") % FILTER_WORDS).cast("int").alias("_word"), F.lit(0).cast("bigint").alias("_mask")
    )
    words = set_bits.unionByName(every).groupBy("_segment", "_word").agg(F.bit_or("_mask").alias("_mask"))
    packed = words.groupBy("_segment").agg(F.sort_array(F.collect_list(F.struct("_word", "_mask"))).alias("_w"))
    return packed.select("_segment", F.col("_w._mask").alias("_words"))


def pass_filter(grams: DataFrame, keys: list[str], source_filter: DataFrame, rows: int) -> DataFrame:
    """The grams whose bits are all set: every gram of the source, and few others.  Broadcast, so no gram moves."""
    place = _filter_place(keys, rows)
    marked = grams.withColumns(place)
    held = F.get("_words", F.col("_word")).bitwiseAND(F.col("_mask")) == F.col("_mask")
    table = F.broadcast(source_filter.withColumnRenamed("_segment", "_row"))
    return marked.join(table, (F.col("_segment") == F.col("_row")) & held, "left_semi").drop(*place)


def ngram_overlap(
    texts: DataFrame,
    sources: DataFrame,
    id_col: str,
    size: int = NGRAM_SIZE,
    key: list[str] | None = None,
    grams_limit: int = BROADCAST_LIMIT_BYTES,
    filter_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Share of a text's whitespace-free n-grams that also occur in its sources.

    ``texts(id_col, [key], text)``, ``sources([key], text)``.  The number of grams is arithmetic, so only
    the membership test explodes.  The source side is distinct, and only grams that it holds are counted.  By the
    size that the source table can reach, (1) its grams are broadcast and the text side moves no gram at all; (2) beyond
    ``grams_limit`` a Bloom filter of them is broadcast, about a thirtieth of that, and the text side moves the grams that it
    lets pass, counted per text: those of the source and at most ``FILTER_FALSE`` of the others, which the exact join drops;
    (3) beyond ``filter_limit`` all grams are counted per text and moved.  The three give the same rows.  A scan with few
    splits is best given redistributed.
    """
    key = key or []
    squeezed = texts.select(id_col, *key, tx.squeeze("text").alias("_squeezed"))
    totals = squeezed.select(
        id_col, F.greatest(F.length("_squeezed") - F.lit(size - 1), F.lit(0)).cast("bigint").alias("n_grams")
    )
    source_grams = text_windows(sources, key, tx.squeeze("text"), size).distinct()
    grams = text_windows(squeezed, [id_col, *key], F.col("_squeezed"), size)
    # at most one gram per byte of text, four bytes of text per compressed byte at the scan; a gram row is at most
    # 4 bytes per character plus row overhead
    most = estimated_bytes(sources) * 4
    if most * (4 * size + 32) <= grams_limit:
        hits = grams.join(F.broadcast(source_grams), [*key, "gram"], "left_semi").groupBy(id_col).agg(F.count(F.lit(1)).alias("_hits"))
    else:
        rows = max(1, -(-most * FILTER_BITS // (64 * FILTER_WORDS)))
        if rows * FILTER_WORDS * 8 <= filter_limit:
            grams = pass_filter(grams, key, gram_filter(source_grams, key, rows), rows)
        counted = grams.groupBy(id_col, *key, "gram").agg(F.count(F.lit(1)).alias("_k"))
        hits = counted.join(source_grams, [*key, "gram"], "left_semi").groupBy(id_col).agg(F.sum("_k").alias("_hits"))
    return totals.join(hits, id_col, "left").select(
        id_col,
        "n_grams",
        F.coalesce("_hits", F.lit(0).cast("bigint")).alias("n_shared"),
        F.when(F.col("n_grams") > 0, F.coalesce("_hits", F.lit(0)) / F.col("n_grams"))
        .otherwise(F.lit(0.0))
        .alias("ratio"),
    )


def overlap_violations(overlap: DataFrame, id_col: str, limit: float = OVERLAP_LIMIT, exempt: DataFrame | None = None) -> DataFrame:
    """Texts whose ratio is strictly above the limit; ids in ``exempt`` (official samples) are left out."""
    over = overlap.filter(F.col("ratio") > limit)
    return over if exempt is None else over.join(exempt.select(id_col).distinct(), id_col, "left_anti")


# Characters of the pieces whose minimum hash anchors a window; any size below VERBATIM_WINDOW gives the same result.
ANCHOR_CHARS = 32


# Parts of a window that tell where its anchor lies, a level each; any numbers give the same result.
STRIP_CLASSES = [1, 8]


def _sliding(values: np.ndarray, width: int, combine: np.ufunc, fill) -> np.ndarray:
    """``combine`` over every full window of ``width`` values, in linear time (prefix and suffix per block)."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, fill, dtype=values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    prefix = combine.accumulate(grid, axis=1).ravel()
    suffix = combine.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return combine(suffix[:count], prefix[width - 1 : width - 1 + count])


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    factors = np.full(count, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _piece_hashes(text: str, piece: int) -> np.ndarray:
    """Hashes of all ``piece``-character windows of a text that has at least one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    # polynomial hash modulo 2**64 from prefix sums; the odd base has the inverse used to shift windows back
    base = 6364136223846793005
    powers = _powers(base, len(codes))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers)))
    starts = len(codes) - piece + 1
    hashes = (sums[piece:] - sums[:-piece]) * _powers(pow(base, -1, 1 << 64), starts)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _anchors_of(text: str, size: int, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (from 0) and hashes of the pieces that are the minimum of some ``size``-character window."""
    if len(text) < size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = _piece_hashes(text, piece)
    width = size - piece + 1
    least = _sliding(hashes, width, np.minimum, np.iinfo(np.uint64).max)
    # a piece is an anchor when the largest minimum among the windows that cover it is its own hash
    edge = np.zeros(width - 1, np.uint64)
    cover = _sliding(np.concatenate((edge, least, edge)), width, np.maximum, 0)
    at = np.flatnonzero(cover == hashes)
    return at, hashes[at].view(np.int64)


def _strips_of(text: str, size: int, piece: int, part: int, ranges=None) -> tuple[np.ndarray, ...]:
    """First and last start (from 0) of the windows in a row of one anchor and class, the hash of their core, their range.

    A window's anchor is its leftmost piece of the least upper half of the hash, its class the offset of that anchor in
    units of ``part``: both depend on the window alone.  The core is what all windows of a class share, so equal windows
    have equal cores, and equal strips hold equal windows.  ``ranges`` (first and last starts) leave out other windows.
    """
    if len(text) < size:
        return (np.empty(0, np.int64),) * 4
    hashes = _piece_hashes(text, piece)
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    at = (_sliding(order, size - piece + 1, np.minimum, np.iinfo(np.uint64).max) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    nth = (at - np.arange(len(at))) // part
    inside = np.zeros(len(at), np.int64)
    if ranges is not None:
        inside -= 1
        for i, (lo, hi) in enumerate(zip(*ranges, strict=True)):
            inside[lo : hi + 1] = i
    changes = (np.diff(at, prepend=-1) != 0) | (np.diff(nth, prepend=-1) != 0) | (np.diff(inside, prepend=-1) != 0)
    first = np.flatnonzero(changes)
    last = np.append(first[1:], len(at)) - 1
    first, last = first[inside[first] >= 0], last[inside[first] >= 0]
    cores = _piece_hashes(text, size - part + 1)[at[first] - nth[first] * part]
    return first, last, cores.view(np.int64), inside[first]


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16]


def _strips(texts: DataFrame, id_col: str, size: int, classes: int, ranges: DataFrame | None = None, piece: int = ANCHOR_CHARS) -> DataFrame:
    """Strips of each text: (id, _text, lo, hi, core, strip, foreign).

    ``lo`` and ``hi`` are the first and last start (from 0) of its windows, ``strip`` is the digest of their characters;
    ``_text`` tells the texts of an id that repeats apart.  With ``ranges(id, _text, lo, hi, foreign)``, only the windows
    that start there; the ranges of a text are gathered first, so a text without any is never read.
    """
    part = max(-(-(size - piece + 1) // classes), 1)
    rows = texts.where(F.col(id_col).isNotNull() & (F.length("text") >= size)).select(id_col, F.xxhash64("text").alias("_text"), "text")
    whole = ranges is None
    if not whole:
        rows = rows.join(ranges.groupBy(id_col, "_text").agg(*[F.collect_list(c).alias(c) for c in ("lo", "hi", "foreign")]), [id_col, "_text"])

    def scan(batches):
        for pdf in batches:
            spans = [None] * len(pdf) if whole else zip(pdf["lo"], pdf["hi"], strict=True)
            foreign = [np.zeros(1, bool)] * len(pdf) if whole else pdf["foreign"]
            for some in _sliced(zip(pdf[id_col], pdf["_text"], foreign, spans, pdf["text"], strict=True)):
                parts = [_strips_of(row[-1], size, piece, part, row[-2]) for row in some]
                lo, hi, core, _ = (np.concatenate(x) for x in zip(*parts, strict=True))
                cut = [_digest(row[-1][i : j + size]) for row, x in zip(some, parts, strict=True) for i, j in zip(x[0].tolist(), x[1].tolist(), strict=True)]
                other = np.concatenate([row[2][x[3]] for row, x in zip(some, parts, strict=True)])
                keys, marks = (np.repeat(np.array([row[c] for row in some]), [len(x[0]) for x in parts]) for c in (0, 1))
                yield pd.DataFrame({id_col: keys, "_text": marks, "lo": lo, "hi": hi, "core": core, "strip": cut, "foreign": other})

    return rows.mapInPandas(scan, f"{id_col} {dict(texts.dtypes)[id_col]}, _text bigint, lo int, hi int, core bigint, strip binary, foreign boolean")


def _sliced(rows, chars: int = 1 << 20):
    """Rows (..., text) in lists of about ``chars`` characters."""
    some, total = [], 0
    for row in rows:
        some.append(row)
        total += len(row[-1])
        if total >= chars:
            yield some
            some, total = [], 0
    if some:
        yield some


def anchors(texts: DataFrame, id_col: str, size: int = VERBATIM_WINDOW, piece: int = ANCHOR_CHARS) -> DataFrame:
    """Content-chosen anchors of each text: (id, at from 0, hash), about two per ``size`` characters.

    A window's anchor depends on its own characters only, so equal windows of two texts share an anchor at the
    same offset.  One vectorised pass per text inside the task; only anchors leave it.
    """

    def scan(batches):
        for pdf in batches:
            parts = [_anchors_of(t, size, piece) for t in pdf["text"]]
            sizes = [len(at) for at, _ in parts]
            yield pd.DataFrame(
                {
                    id_col: np.repeat(pdf[id_col].to_numpy(), sizes),
                    "at": np.concatenate([at for at, _ in parts]) if parts else [],
                    "h": np.concatenate([h for _, h in parts]) if parts else [],
                }
            )

    rows = texts.select(id_col, F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(scan, f"{id_col} {dict(texts.dtypes)[id_col]}, at bigint, h bigint")


def verbatim_windows(
    texts: DataFrame, sources: DataFrame, id_col: str, source_id: str, size: int = VERBATIM_WINDOW
) -> DataFrame:
    """Start positions of a text whose ``size``-character window occurs verbatim in a source: (id, pos from 1).

    (1) Both sides give only their anchors; equal windows share one, so a window without a common anchor has no
    match.  (2) Windows are built around common anchors only, and (3) compared by the sha256 of their characters.
    Nothing is sampled, and the source side is distinct before each join, so a passage that fills a third of the
    corpus meets each text once instead of pairing with every copy.
    """
    met = anchors(texts, id_col, size).join(anchors(sources, source_id, size).select("h").distinct(), "h", "left_semi")
    held = anchors(sources, source_id, size).join(met.select("h").distinct(), "h", "left_semi")
    theirs = _windows_at(sources, held, source_id, size).select("digest").distinct()
    return _windows_at(texts, met, id_col, size).join(theirs, "digest", "left_semi").select(id_col, "pos")


def copied_windows(texts: DataFrame, id_col: str, size: int = VERBATIM_WINDOW) -> DataFrame:
    """Start positions of a text whose window also occurs in another text of the same table: (id, pos from 1).

    Windows of one anchor and class lie in a row and meet as one strip.  (1) A strip that several texts have whole is
    copied, with all its windows.  (2) Equal windows have equal cores, so of the other strips only those whose core is
    also another strip's are cut into finer ones, at last into windows; of a strip that several texts have, one copy is
    cut to compare with.  Owners are smallest and largest ids, partial aggregates, so copies are combined before they
    are shuffled and never meet as pairs.
    """
    hits, ranges = [], None
    for classes in [*STRIP_CLASSES, size]:
        rows = written(_strips(texts, id_col, size, classes, ranges), "strips")
        place = F.struct(id_col, "_text", "lo", "hi")
        held = rows.groupBy("strip").agg(F.max("core").alias("core"), F.min(place).alias("_one"), F.max(id_col).alias("_last"), F.max("foreign").alias("_several"))
        held = held.withColumn("_several", F.col("_several") | (F.col("_one")[id_col] != F.col("_last")))
        if classes == size:
            judged = held.where("_several").select("strip", "_several")
        else:
            open_ = held.groupBy("core").agg(F.count(F.lit(1)).alias("_n"), F.count_if(~F.col("_several")).alias("_single")).where("_n > 1 AND _single > 0")
            judged = held.join(open_.select("core", F.lit(True).alias("_open")), "core", "left").where("_several OR _open").drop("core", "_last")
            judged = written(judged, "strips-judged")
        mine = rows.where("NOT foreign").join(judged.select("strip", "_several"), "strip")
        hits.append(mine.where("_several").select(id_col, F.explode(F.sequence((F.col("lo") + 1).cast("bigint"), (F.col("hi") + 1).cast("bigint"))).alias("pos")))
        if classes != size:
            ranges = mine.where("NOT _several").select(id_col, "_text", "lo", "hi", F.lit(False).alias("foreign")).distinct()
            ranges = ranges.unionByName(judged.where("_several AND _open").select("_one.*", F.lit(True).alias("foreign")))
    return reduce(DataFrame.unionByName, hits)


def _windows_at(texts: DataFrame, hits: DataFrame, id_col: str, size: int, piece: int = ANCHOR_CHARS) -> DataFrame:
    """Digests of the windows around anchors: (id, pos from 1, digest).

    A window that holds the anchor starts at most ``size - piece`` characters before it.  Starts are grouped in
    cells of half a window; a cell's strip is cut from the text once, however many anchors ask for it.  The cells
    wanted of a text are gathered first (no more than the text has), so a text without a common anchor is never cut.
    """
    cell = size // 2
    first = F.floor(F.greatest(F.col("at") - (size - piece), F.lit(0)) / cell)
    wanted = hits.select(id_col, F.explode(F.sequence(first.cast("int"), F.floor(F.col("at") / cell).cast("int"))).alias("cell")).distinct()
    strips = F.regexp_extract_all(
        F.col("text"), F.lit(rf"(?s)(?=(.{{1,{cell + size - 1}}}+)).{{1,{cell}}}+"), F.lit(1)
    )
    cells = wanted.groupBy(id_col).agg(F.collect_list("cell").alias("_cells"))
    picked = tx.let(strips, lambda s: F.transform("_cells", lambda c: F.struct(c.alias("cell"), F.get(s, c).alias("_strip"))))
    pieces = texts.join(cells, id_col).select(id_col, F.inline(picked)).filter(F.length("_strip") >= size)
    grams = F.regexp_extract_all(F.col("_strip"), F.lit(rf"(?s)(?=(.{{{size}}})).{{1}}"), F.lit(1))
    return (
        pieces.select(id_col, "cell", F.posexplode(grams).alias("_in", "_gram"))
        .select(id_col, (F.col("cell") * cell + F.col("_in") + 1).cast("bigint").alias("pos"), F.unhex(F.sha2("_gram", 256)).alias("digest"))
    )


# -- selection and jobs -------------------------------------------------------------------------

def select_units(units: DataFrame, selectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units addressed by slug, label or (chapters only) ordinal, and the selectors that match none.

    ``units(slug, label, ordinal, unit_class)`` with class ``chapter`` or ``appendix``; ``selectors(selector)``.
    """
    names = units.select(
        "slug",
        F.explode(
            F.array_compact(
                F.array(
                    F.col("slug"),
                    F.col("label"),
                    F.when(F.col("unit_class") == "chapter", F.col("ordinal").cast("string")),
                )
            )
        ).alias("selector"),
    )
    wanted = selectors.select(F.trim("selector").alias("selector")).filter(F.col("selector") != "").distinct()
    picked = units.join(names.join(wanted, "selector", "left_semi").select("slug").distinct(), "slug", "left_semi")
    return picked, wanted.join(names, "selector", "left_anti")


def assign_types(points: DataFrame, unit_col: str, declared: list[str]) -> DataFrame:
    """Question type per point: preferred by level, then every unused declared type takes over one point.

    ``points(unit, pos, requirement)``, ``pos`` unique per unit.  The takeover is greedy: an unused type goes to
    the last point whose current type is held more than once.  Only the last ``k`` points of each (unit, current
    type) can ever be taken (``k`` = number of declared types), so a unit of any size is reduced to at most
    ``k * k`` rows, with its exact group sizes, before the greedy step; all other points keep their type.
    """
    k = len(declared)
    preferred = F.coalesce(
        *[F.when(F.col("requirement") == level, F.lit(kind)) for level, kind in PREFERRED_TYPE.items() if kind in declared],
        F.lit(declared[0]),
    )
    first = points.select(unit_col, "pos", preferred.alias("question_type"))
    sizes = first.groupBy(unit_col, "question_type").agg(F.count(F.lit(1)).alias("held"))
    from_end = Window.partitionBy(unit_col, "question_type").orderBy(F.desc("pos"))
    tails = (
        first.withColumn("_rn", F.row_number().over(from_end))
        .filter(F.col("_rn") <= k)
        .join(sizes, [unit_col, "question_type"])
        .groupBy(unit_col)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "question_type", "held")), asc=False).alias("_tail"))
    )
    change = T.StructType([T.StructField("pos", T.LongType()), T.StructField("kind", T.StringType())])

    @F.pandas_udf(T.ArrayType(change))
    def takeover(tail: pd.Series) -> pd.Series:
        def one(rows):
            current = {r["pos"]: r["question_type"] for r in rows}
            held = {r["question_type"]: r["held"] for r in rows}
            changes = []
            for kind in [d for d in declared if d not in held]:
                donor = next((p for p in current if held[current[p]] > 1), None)
                if donor is not None:
                    held[current[donor]] -= 1
                    current[donor], held[kind] = kind, 1
                    changes.append({"pos": donor, "kind": kind})
            return changes

        return tail.map(one)

    changes = tails.select(unit_col, F.inline(takeover("_tail"))).withColumnRenamed("kind", "_new")
    return first.join(changes, [unit_col, "pos"], "left").select(
        unit_col, "pos", F.coalesce("_new", "question_type").alias("question_type")
    )


def worklist(points: DataFrame, prompts: dict[str, tuple[str, str]], course_col: str, payload: list[str]) -> DataFrame:
    """One job per point and kind, plus one course-level job, each with its payload hash and canonical order.

    ``prompts`` maps kind to (prompt id, version); the entry ``stage_plan`` is the course-level one.
    """
    kinds = [k for k in prompts if k != "stage_plan"]
    spec = F.array(
        *[
            F.struct(
                F.lit(i).alias("kind_order"), F.lit(k).alias("kind"),
                F.lit(prompts[k][0]).alias("prompt_id"), F.lit(prompts[k][1]).alias("prompt_version"),
            )
            for i, k in enumerate(kinds)
        ]
    )
    jobs = points.select("*", F.explode(spec).alias("_k")).select(*points.columns, "_k.*")
    hashed = {name: F.col(name) for name in payload} | {"kind": F.col("kind")}
    jobs = jobs.select(
        course_col, "point_id", "kind_order", "kind", "prompt_id", "prompt_version",
        tx.canonical_hash(hashed).alias("payload_hash"),
    )
    courses = points.select(course_col).distinct().select(
        course_col,
        F.lit(None).cast("string").alias("point_id"),
        F.lit(len(kinds)).alias("kind_order"),
        F.lit("stage_plan").alias("kind"),
        F.lit(prompts["stage_plan"][0]).alias("prompt_id"),
        F.lit(prompts["stage_plan"][1]).alias("prompt_version"),
    )
    courses = courses.withColumn(
        "payload_hash", tx.canonical_hash({course_col: F.col(course_col), "kind": F.col("kind")})
    )
    return jobs.unionByName(courses)


def replay_join(jobs: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs with their recorded response, and the jobs that have none (never invented)."""
    on = ["prompt_id", "prompt_version", "payload_hash"]
    return jobs.join(responses, on), jobs.join(responses, on, "left_anti")


def merge_blocks(existing: DataFrame, new: DataFrame, course_col: str) -> DataFrame:
    """Point-level rows upsert by block id; course-level rows (no point) are those of ``new`` only.

    Both sides carry (course, block_id, point_id, ...).  A course absent from ``new`` keeps its point rows.
    """
    old_points = existing.filter(F.col("point_id").isNotNull())
    kept = old_points.join(new.filter(F.col("point_id").isNotNull()), [course_col, "block_id"], "left_anti")
    return kept.select(*new.columns).unionByName(new)


def merge_problems(existing: DataFrame, new: DataFrame, course_col: str) -> DataFrame:
    """Point-level rows without a block id, and courses of ``existing`` that ``new`` does not rebuild."""
    sides = existing.select(course_col, "block_id", "point_id", F.lit("existing").alias("side")).unionByName(
        new.select(course_col, "block_id", "point_id", F.lit("new").alias("side"))
    )
    blank = sides.filter(F.col("point_id").isNotNull() & (F.coalesce("block_id", F.lit("")) == ""))
    other = existing.select(course_col).distinct().join(new.select(course_col).distinct(), course_col, "left_anti")
    return as_findings(blank, "merge", "block_id_missing", F.col(course_col), F.col("side")).unionByName(
        as_findings(other, "merge", "entity_mismatch", F.col(course_col), "not part of this build")
    )


def canonical_order(blocks: DataFrame, order: DataFrame, kinds: list[str]) -> DataFrame:
    """Sort keys of the one canonical block order; ``order_problem`` names an unknown kind or point.

    ``order(point_id, unit_class, ordinal, section_pos, point_pos)``.
    """
    kind_order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).cast("int")
    # course-level blocks have no point id and stay out of the join
    pointed = blocks.filter(F.col("point_id").isNotNull()).join(order.withColumn("_known", F.lit(True)), "point_id", "left")
    joined = pointed.unionByName(blocks.filter(F.col("point_id").isNull()), allowMissingColumns=True)
    problem = F.when(kind_order == 0, F.lit("unknown kind")).when(
        F.col("point_id").isNotNull() & F.col("_known").isNull(), F.lit("unknown point")
    )
    zero = F.lit(0)
    return joined.select(
        *blocks.columns,
        F.col("point_id").isNull().cast("int").alias("course_level"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("unit_class", "ordinal", "section_pos", "point_pos")],
        kind_order.alias("kind_order"),
        problem.alias("order_problem"),
    )


ORDER_KEYS = ["course_level", "unit_class", "ordinal", "section_pos", "point_pos", "kind_order"]


# -- validation ---------------------------------------------------------------------------------

def _blank(c: Column) -> Column:
    return F.coalesce(tx.strip_ws(c), F.lit("")) == ""


def block_rules(kinds_known: Column) -> list:
    """Row rules of a block; ``point_known`` and ``type_declared`` are joined in by the caller."""
    kind, text = F.col("kind"), F.col("text_md")
    body = F.coalesce(text, F.lit(""))
    is_point = kind.isin("explain", "memorize", "drill") & F.col("point_known") & ~_blank(text)
    false = F.lit(False)

    def has_any(words: list[str]) -> Column:
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: body.contains(w))

    def has_all(words: list[str]) -> Column:
        return F.forall(F.array(*[F.lit(w) for w in words]), lambda w: body.contains(w))

    return [
        ("block_id_missing", F.coalesce("block_id", F.lit("")) == "", "block_id"),
        ("ai_label", ~F.coalesce("ai_generated", false), "ai_generated"),
        ("review_state", ~(F.coalesce("review_state", F.lit("")) == "machine_draft"), F.col("review_state")),
        ("kind", ~kinds_known, kind),
        (
            "point_unknown",
            kind.isin("explain", "memorize", "drill") & ~F.col("point_known"),
            F.col("point_id"),
        ),
        ("text_empty", kind.isin("explain", "memorize", "drill") & F.col("point_known") & _blank(text), kind),
        ("explain_headings", is_point & (kind == "explain") & ~has_all(EXPLAIN_HEADINGS), kind),
        ("explain_short", is_point & (kind == "explain") & (F.length(body) < MIN_CHARS["explain"]), F.length(body)),
        (
            "memorize_weak",
            is_point & (kind == "memorize") & ((F.length(body) < MIN_CHARS["memorize"]) | ~has_any(MEMORY_WORDS)),
            F.length(body),
        ),
        ("drill_answer", is_point & (kind == "drill") & _blank(F.col("answer_md")), kind),
        (
            "drill_source_kind",
            is_point & (kind == "drill") & ~F.coalesce(F.col("source_kind").isin(SOURCE_KINDS), false),
            F.col("source_kind"),
        ),
        ("drill_type", is_point & (kind == "drill") & ~F.col("type_declared"), F.col("question_type")),
        (
            "strategy_scope",
            (kind == "exam_strategy") & F.col("point_id").isNotNull(),
            F.col("point_id"),
        ),
        (
            "strategy_short",
            (kind == "exam_strategy") & (F.length(tx.strip_ws(body)) < MIN_CHARS["exam_strategy"]),
            F.length(body),
        ),
    ]


def validate_blocks(
    blocks: DataFrame, points: DataFrame, declared: DataFrame, course_col: str
) -> DataFrame:
    """All block findings: row rules, duplicate ids, and courses without exactly one strategy block.

    ``blocks(course, block_id, kind, point_id, text_md, answer_md, question_type, source_kind, ai_generated,
    review_state)``, ``points(course, point_id)``, ``declared(course, question_type)`` (empty = no rule).
    """
    known = points.select(course_col, "point_id", F.lit(True).alias("_p")).distinct()
    types = declared.select(course_col, "question_type", F.lit(True).alias("_t")).distinct()
    has_types = declared.select(course_col, F.lit(True).alias("_any")).distinct()
    joined = (
        blocks.join(known, [course_col, "point_id"], "left")
        .join(types, [course_col, "question_type"], "left")
        .join(has_types, course_col, "left")
        .withColumn("point_known", F.col("_p").isNotNull())
        .withColumn("type_declared", F.col("_t").isNotNull() | F.col("_any").isNull())
    )
    entity = F.concat_ws("/", F.col(course_col).cast("string"), F.col("block_id"))
    kinds_known = F.coalesce(F.col("kind").isin(BLOCK_KINDS), F.lit(False))
    rows = rule_findings(joined, "content", entity, block_rules(kinds_known))
    dup = blocks.groupBy(course_col, "block_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    dup = as_findings(dup, "content", "block_id_duplicate", F.concat_ws("/", F.col(course_col).cast("string"), "block_id"), F.col("n"))
    strategy = (
        blocks.groupBy(course_col)
        .agg(F.count_if(F.col("kind") == "exam_strategy").alias("n"))
        .filter(F.col("n") != 1)
    )
    strategy = as_findings(strategy, "content", "strategy_count", F.col(course_col), F.col("n"))
    return rows.unionByName(dup).unionByName(strategy)


def coverage_gaps(points: DataFrame, blocks: DataFrame, kinds: list[str], keys: list[str]) -> DataFrame:
    """Point x required kind without a block (the kinds are a literal list exploded per point)."""
    want = points.select(*keys).distinct().withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    return want.join(blocks.select(*keys, "kind").distinct(), [*keys, "kind"], "left_anti")


def validate_stages(stages: DataFrame, course_col: str, names: list[str] | None = None) -> DataFrame:
    """Exactly the named stages in order, with non-empty text and lists.

    ``stages(course, pos, stage, goal, done_when, inputs, how, outputs)``, ``pos`` from 1.
    """
    names = names or STAGES
    expected = F.try_element_at(F.array(*[F.lit(n) for n in names]), F.col("pos").cast("int"))
    filled = lambda c: F.exists(F.col(c), lambda x: ~_blank(x))
    rules = [
        ("stage_name", ~expected.eqNullSafe(F.col("stage")), F.col("stage")),
        ("goal_empty", _blank(F.col("goal")), "goal"),
        ("done_when_empty", _blank(F.col("done_when")), "done_when"),
    ] + [(f"{c}_empty", ~F.coalesce(filled(c), F.lit(False)), c) for c in ("inputs", "how", "outputs")]
    rows = rule_findings(stages, "stages", F.col(course_col), rules, locator=F.col("pos"))
    counts = stages.groupBy(course_col).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pos").alias("d"))
    counts = counts.filter((F.col("n") != len(names)) | (F.col("d") != len(names)))
    return rows.unionByName(as_findings(counts, "stages", "stage_count", F.col(course_col), F.col("n")))


def official_sample_rules(blocks: DataFrame, entity: Column) -> DataFrame:
    """Official samples need a checkable provenance and at most 200 characters.

    ``blocks(..., text_md, answer_md, prov_doc_id, prov_locator, prov_kind)``.
    """
    size = F.length(F.concat(F.coalesce("text_md", F.lit("")), F.lit("\n"), F.coalesce("answer_md", F.lit(""))))
    rules = [
        (f"sample_{c}", _blank(F.col(f"prov_{c}")), c) for c in ("doc_id", "locator", "kind")
    ] + [("sample_length", size > MAX_SAMPLE_CHARS, size)]
    return rule_findings(blocks, "content", entity, rules)


def emitted_texts(blocks: DataFrame, stages: DataFrame, schedule: DataFrame) -> DataFrame:
    """All natural-language output as (label, text): blocks, stages, gap texts and repetition lists."""
    from_blocks = blocks.select(
        F.concat(F.lit("block "), F.col("block_id").cast("string")).alias("label"),
        F.concat_ws("\n", "text_md", "answer_md").alias("text"),
    )
    lists = F.flatten(F.array(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("inputs", "how", "outputs")]))
    from_stages = stages.select(
        F.concat(F.lit("stage_plan["), (F.col("pos") - 1).cast("string"), F.lit("]·"), F.col("stage")).alias("label"),
        F.array_join(F.concat(F.filter(F.array("stage", "goal", "done_when"), lambda x: x.isNotNull() & (x != "")), lists), "\n").alias("text"),
    )
    gaps = schedule.select(
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit("review_schedule.gap_impact").alias("label"), F.col("gap_impact").alias("text")),
                    F.struct(F.lit("review_schedule.next_evidence").alias("label"), F.col("next_evidence").alias("text")),
                    F.struct(
                        F.concat(F.lit("review_schedule.plans["), F.col("tier"), F.lit("].spaced_repetition")).alias("label"),
                        F.col("spaced_repetition").alias("text"),
                    ),
                ),
                lambda x: x.label.isNotNull() & x.text.isNotNull() & (x.text != ""),
            )
        ).alias("e")
    ).select("e.label", "e.text")
    return from_blocks.unionByName(from_stages).unionByName(gaps)


# -- answer keys --------------------------------------------------------------------------------

FAMILY_LABELS = {"single_choice": ["A", "B", "C", "D"], "judgement": ["正确", "错误"]}


def label_answers(blocks: DataFrame) -> DataFrame:
    """Drill blocks with answer ``family`` and ``label`` (null label inside a family = unparseable)."""
    return blocks.withColumn("_a", tx.answer_label("question_type", "answer_md")).select(
        *blocks.columns, F.col("_a.family").alias("family"), F.col("_a.label").alias("label")
    )


def answer_distribution(
    answers: DataFrame, entity: str, limits: dict[str, int] | None = None, min_samples: int = MIN_ANSWERS
) -> DataFrame:
    """Per entity and family: sample size, top label, share, verdict, unparseable count.

    ``answers(entity, family, label)``; counts per (entity, family, label) combine before the shuffle, so a
    hot entity sends a handful of rows.  Ties go to the greatest label; percentages compare as integers.
    """
    limits = limits or SHARE_LIMITS
    per_label = (
        answers.filter(F.col("family").isNotNull())
        .groupBy(entity, "family", "label")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    parsed = F.col("label").isNotNull()
    out = per_label.groupBy(entity, "family").agg(
        F.coalesce(F.sum(F.when(parsed, F.col("cnt"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~parsed, F.col("cnt"))), F.lit(0)).alias("unparseable"),
        F.max_by(F.when(parsed, F.col("label")), F.when(parsed, F.struct("cnt", "label"))).alias("top"),
        F.coalesce(F.max(F.when(parsed, F.col("cnt"))), F.lit(0)).alias("top_count"),
    )
    limit = F.coalesce(*[F.when(F.col("family") == f, F.lit(v)) for f, v in limits.items()])
    return out.select(
        entity, "family", "n", "unparseable", "top", "top_count",
        F.when(F.col("n") > 0, F.col("top_count") / F.col("n")).alias("max_share"),
        limit.alias("limit_percent"),
        F.when(F.col("n") < min_samples, F.lit("insufficient-sample"))
        .when(F.col("top_count") * 100 > limit * F.col("n"), F.lit("biased"))
        .otherwise(F.lit("ok"))
        .alias("verdict"),
    )


def enforce_scope(distribution: DataFrame, tracked: DataFrame, entity: str) -> DataFrame:
    """Turn bias and parse gaps into findings, except for tracked entities; unknown state is enforced.

    ``tracked(entity, tracked BOOLEAN nullable)``.
    """
    joined = distribution.join(tracked.select(entity, "tracked"), entity, "left")
    enforced = ~F.col("tracked").eqNullSafe(F.lit(True))
    rules = [
        ("unparseable", enforced & (F.col("unparseable") > 0), F.col("unparseable")),
        ("biased", enforced & (F.col("verdict") == "biased"), F.concat_ws(" ", "top", F.col("top_count").cast("string"))),
    ]
    return rule_findings(joined, "answers", F.col(entity), rules, locator=F.col("family"))


def family_coverage(answers: DataFrame, entity: str) -> DataFrame:
    """Drills per entity and how many fell into an answer family; ``family_not_matched`` when none did."""
    return (
        answers.groupBy(entity)
        .agg(
            F.count(F.lit(1)).alias("drills"),
            F.count_if(F.col("family") == "single_choice").alias("single_choice"),
            F.count_if(F.col("family") == "judgement").alias("judgement"),
        )
        .withColumn("family_not_matched", (F.col("drills") > 0) & (F.col("single_choice") + F.col("judgement") == 0))
    )


# -- page reach ---------------------------------------------------------------------------------

def point_reach(blocks: DataFrame, sections: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks that did not reach their section: missing anchor, missing heading or empty body.

    ``blocks(keys, kind)``; ``sections(keys, kind, body)`` has one row per (anchor, heading kind), ``body``
    null when the anchor exists but the heading does not; last duplicate already resolved.
    """
    anchors = sections.select(*keys, F.lit(True).alias("_anchor")).distinct()
    bodies = sections.filter(F.col("body").isNotNull()).groupBy(*keys, "kind").agg(F.max("body").alias("body"))
    state = (
        F.when(F.col("_anchor").isNull(), F.lit("missing_anchor"))
        .when(F.col("body").isNull(), F.lit("missing_heading"))
        .when(_blank(F.col("body")), F.lit("empty_body"))
    )
    return (
        blocks.select(*keys, "kind").distinct()
        .join(anchors, keys, "left")
        .join(bodies, [*keys, "kind"], "left")
        .withColumn("problem", state)
        .filter(F.col("problem").isNotNull())
        .select(*keys, "kind", "problem")
    )


def count_reconcile(
    blocks: DataFrame, headings: DataFrame, keys: list[str], exact: list[str], at_least: list[str]
) -> DataFrame:
    """Block counts against visible heading counts; ``at_least`` kinds only need a lower bound.

    ``blocks(keys, kind)``, ``headings(keys, kind)``.  Both sides are counted before they meet.
    """
    expected = blocks.groupBy(*keys, "kind").agg(F.count(F.lit(1)).alias("expected"))
    rendered = headings.groupBy(*keys, "kind").agg(F.count(F.lit(1)).alias("rendered"))
    zero = F.lit(0).cast("bigint")
    both = expected.join(rendered, [*keys, "kind"], "full").select(
        *keys, "kind", F.coalesce("expected", zero).alias("expected"), F.coalesce("rendered", zero).alias("rendered")
    )
    kind = F.col("kind")
    return both.filter(
        (kind.isin(exact) & (F.col("rendered") != F.col("expected")))
        | (kind.isin(at_least) & (F.col("rendered") < F.col("expected")))
    )


def ordered_names_equal(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Positions where two ordered name lists differ (missing positions count)."""
    l = left.select(*keys, "pos", F.col(name).alias("left_name"))
    r = right.select(*keys, "pos", F.col(name).alias("right_name"))
    return l.join(r, [*keys, "pos"], "full").filter(~F.col("left_name").eqNullSafe(F.col("right_name")))


def glob_to_regex(pattern: str) -> str:
    """File glob (``*``, ``?``) as an anchored regex over the relative path; ``*`` also crosses ``/``."""
    out = "".join({"*": ".*", "?": "."}.get(ch, "\\" + ch if ch in r".^$+{}[]()|\\" else ch) for ch in pattern)
    return rf"(?s)\A{out}\z"


def matches_page(path: Column | str, patterns: list[str]) -> Column:
    """Glob match, or a plain prefix once trailing stars are removed."""
    rel = tx.col(path)
    hits = [rel.rlike(glob_to_regex(p)) | rel.startswith(p.rstrip("*")) for p in patterns]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out


def page_marks(
    pages: DataFrame, path: str, text: str, marker: str, banner: str, ai_pages: list[str], official: list[str]
) -> DataFrame:
    """Generated marker on every page, banner exactly on AI pages, never on official ones."""
    has_banner = F.col(text).contains(banner)
    is_official, is_ai = matches_page(path, official), matches_page(path, ai_pages)
    rules = [
        ("marker_missing", ~F.col(text).contains(marker), marker),
        ("banner_on_official", is_official & has_banner, banner),
        ("banner_missing", ~is_official & is_ai & ~has_banner, banner),
    ]
    return rule_findings(pages, "pages", F.col(path), rules)


def blockquote_rules(lines: DataFrame, entity: str, limit: int = MAX_QUOTE_LINE_CHARS, question: str = QUESTION_LIKE) -> DataFrame:
    """Quoted lines that are too long or read like an exam question."""
    stripped = tx.strip_ws("text")
    quote = tx.strip_ws(F.ltrim(stripped, F.lit(">")))
    quoted = lines.filter(F.regexp_replace(F.col("text"), rf"^{tx.SPACE}+", "").startswith(">"))
    rules = [
        ("quote_long", F.length(quote) > limit, F.length(quote)),
        ("quote_question", quote.rlike(question), F.length(quote)),
    ]
    return rule_findings(quoted, "pages", F.col(entity), rules, locator=F.concat(F.lit("L"), F.col("line_no").cast("string")))


def orphan_products(sources: DataFrame, rendered: DataFrame, key: str) -> DataFrame:
    """Union of both key sides: products without a source, sources without a product.

    ``sources(key)``, ``rendered(key, has_banner)``; only products that carry the banner can be orphans.
    """
    s = sources.select(key).distinct().withColumn("_s", F.lit(True))
    r = rendered.groupBy(key).agg(F.count_if(F.col("has_banner")).alias("banner_pages")).withColumn("_r", F.lit(True))
    problem = F.when(F.col("_s").isNull() & (F.col("banner_pages") > 0), F.lit("source_missing")).when(
        F.col("_r").isNull(), F.lit("not_rendered")
    )
    return (
        s.join(r, key, "full")
        .select(key, F.coalesce("banner_pages", F.lit(0).cast("bigint")).alias("banner_pages"), problem.alias("problem"))
        .filter(F.col("problem").isNotNull())
    )


def filler_lines(lines: DataFrame, entity: str, budget: int, pattern: str = FILLER_LINE) -> DataFrame:
    """Placeholder lines per entity against a budget."""
    return (
        lines.groupBy(entity)
        .agg(F.count_if(F.col("text").rlike(pattern)).alias("filler"))
        .filter(F.col("filler") > 0)
        .withColumn("over_budget", F.col("filler") > budget)
    )


def derived_equals_source(derived: DataFrame, source: DataFrame, stem: str, payload: str, key: str) -> DataFrame:
    """Derived rows whose stem exists in the source but whose payload equals none of its matches.

    Both sides are reduced to distinct (stem, payload) first, so repeated stems do not multiply.
    """
    stems = source.select(stem).distinct()
    exact = source.select(stem, payload).distinct()
    return derived.join(stems, stem, "left_semi").join(exact, [stem, payload], "left_anti").select(key, stem, payload)


def claim_conflicts(texts: DataFrame, status: DataFrame, key: str, matched_claim: str) -> DataFrame:
    """Text claims against recorded status, and claims that contradict each other.

    ``texts(key, text)``, ``status(key, plan_status)``.
    """
    t = F.col("text")
    joined = texts.join(status.select(key, "plan_status"), key, "left")
    matched = F.coalesce(F.col("plan_status") == "matched", F.lit(False))
    rules = [
        ("claims_matched", t.contains(matched_claim) & ~matched, F.col("plan_status")),
        ("denies_ai", t.rlike(AI_CREDIT) & t.rlike(NO_AI_CLAIM), F.regexp_extract(t, NO_AI_CLAIM, 0)),
        ("missing_chapter", t.rlike(MISSING_CHAPTER_CLAIM), F.regexp_extract(t, MISSING_CHAPTER_CLAIM, 0)),
    ]
    return rule_findings(joined, "claims", F.col(key), rules)


def scope_gaps(entities: DataFrame, scopes: DataFrame, templates: list[str], key: str) -> DataFrame:
    """Entity x required template whose declared scope does not hold the entity.

    ``scopes(template, entity)`` is the exploded scope list.
    """
    want = entities.select(key).distinct().withColumn("template", F.explode(F.array(*[F.lit(t) for t in templates])))
    return want.join(scopes.select("template", key).distinct(), ["template", key], "left_anti")
