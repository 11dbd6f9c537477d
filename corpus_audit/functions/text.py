"""Column functions over strings: urls, paths, whitespace, numerals, Markdown fragments, hashes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character classes and lists that decide results.
# any white space; the class names its characters, so that a regex looks most of them up in one table
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_BREAKS = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85  ]"
RARE_BREAKS = r"[\r\x0b\f\x1c-\x1e\x85\u2028\u2029]"
URL_TAIL = ".,;:。，、；)）]】>"
CLAUSE_MARKS = "，、：,;"
CJK_DIGITS = "一二三四五六七八九"
META_HEADER = "| 字段 | 内容 |"
TABLE_HEADER_LABELS = ["字段", "项目", "类型", "类别"]
MULTI_ANSWER_JOINERS = r"\s、,，/;；\-–—|*和或与及至"
MAX_QUOTE_CHARS = 60
COUNT_COMMENT = r"<!--\s*AUTO_GEN_COUNT:\s*([^>]+?)\s*-->"
COUNT_CELL = r"AUTO_GEN_COUNT\s*\|\s*([^|]+)"
COUNT_FRONT = r"(?s)auto_gen_count:\s+normal:\s*(\d+)\s+transition:\s*(\d+)\s+total:\s*(\d+)"
COUNT_FIELD = r"{key}\s*=\s*(\d+)"
LIST_INLINE, LIST_NESTED, LIST_ITEM = r"{key}\s*:\s*\[([^\]]*)\]", r"{key}\s*:\s*\n((?:\s+-\s+[^\n]+\n?)*)", r"-\s+([^\n]+)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: array expressions get no common-subexpression elimination."""
    return F.element_at(F.transform(F.array(value), body), 1)


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` whose no-match result is null instead of the empty string."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


# -- whitespace ---------------------------------------------------------------------------------

def strip_ws(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def fold_ws(c: Column | str) -> Column:
    """Every whitespace run becomes one space; ends trimmed."""
    return F.trim(F.regexp_replace(col(c), rf"{SPACE}+", " "))


def squeeze(c: Column | str) -> Column:
    """All whitespace deleted."""
    return F.regexp_replace(col(c), rf"{SPACE}+", "")


def physical_lines(c: Column | str) -> Column:
    """Lines by ``\\n`` only, the numbering behind every ``L<n>`` locator."""
    return F.split(col(c), "\n", -1)


def display_lines(c: Column | str) -> Column:
    """Lines by every Unicode line boundary; a trailing boundary opens no extra line.

    A text whose only boundary is ``\\n`` is split without a regex.
    """
    return let(
        let(col(c), lambda text: F.when(text.rlike(RARE_BREAKS), F.split(text, LINE_BREAKS, -1)).otherwise(F.split(text, "\n", -1))),
        lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts),
    )


# Codes of an entity: five digits unless a caller's keys may be longer
FIVE_DIGITS, FIVE_OR_MORE = "[0-9]{5}", "[0-9]{5,}"

# -- urls and paths -----------------------------------------------------------------------------

_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?"


def normalize_url(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(URL_TAIL))


def host_of(c: Column | str) -> Column:
    """Lower-cased host without user info, brackets or port; ``''`` when there is none."""
    host = F.regexp_extract(col(c), _NETLOC + r"(\[[^\]/?#]*\]|[^:/?#]*)", 1)
    return F.lower(F.translate(F.coalesce(host, F.lit("")), "[]", ""))


def is_in_domain(c: Column | str, domain: str) -> Column:
    host = host_of(c)
    return (host == domain.lower()) | host.endswith("." + domain.lower())


def _url_tail(c: Column | str) -> Column:
    path = F.regexp_extract(col(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def url_slug(c: Column | str) -> Column:
    """File-safe stem of the last path part, ``index`` when there is none."""
    tail = _url_tail(c)
    stem = F.coalesce(extract_or_null(tail, r"^(.+)\.[^.]+$"), tail)
    slug = F.btrim(F.regexp_replace(stem, r"[^0-9A-Za-z._\-]+", "-"), F.lit("-."))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("index"))


def url_extension(c: Column | str, default: str = ".html") -> Column:
    return F.coalesce(extract_or_null(_url_tail(c), r"^.+(\.[^.]+)$"), F.lit(default))


def entity_code_from_path(c: Column | str, digits: str = FIVE_DIGITS) -> Column:
    """Code as the stem, else as the parent directory of a ``.md`` file, else null."""
    path = col(c)
    return F.coalesce(
        extract_or_null(path, rf"(?:^|/)({digits})(?:\.[^./]+)?$"),
        extract_or_null(path, rf"(?:^|/)({digits})/[^/]+\.[mM][dD]$"),
    )


def entity_route(c: Column | str, digits: str = FIVE_DIGITS) -> Column:
    return F.concat(F.lit("/courses/"), entity_code_from_path(c, digits), F.lit("/"))


def normalize_href(c: Column | str, prefix: str = "", digits: str = FIVE_DIGITS) -> Column:
    """Absolute and anchor hrefs stay, relative entity links become routes, a trailing ``.md`` is dropped."""
    href = strip_ws(c)
    major = r"^(?:\./|\.\./)+majors/([^/#?]+)(/)?([#?].*)?$"
    course = rf"^(?:\./|\.\./)*(?:courses/)?({digits})(?:/|\.md)?$"
    return (
        F.when(href.rlike(r"^(?:https?://|#|//)"), href)
        .when(href.startswith("/"), F.concat(F.lit(prefix), href))
        .when(
            href.rlike(major),
            F.concat(
                F.lit(prefix + "/majors/"), F.regexp_extract(href, major, 1), F.lit("/"),
                F.regexp_extract(href, major, 3),
            ),
        )
        .when(href.rlike(course), F.concat(F.lit(prefix + "/courses/"), F.regexp_extract(href, course, 1), F.lit("/")))
        .when(href.endswith(".md"), F.regexp_replace(href, r"\.md$", ""))
        .otherwise(href)
    )


def source_tier(c: Column | str, names: list[str]) -> Column:
    """1-based rank of the first name the path ends with or holds as a directory; unknown ranks last."""
    path = col(c)
    rank = None
    for position, name in enumerate(names, 1):
        hit = path.endswith(name) | path.contains(f"/{name}/")
        rank = F.when(hit, F.lit(position)) if rank is None else rank.when(hit, F.lit(position))
    unknown = F.lit(len(names) + 1)
    return unknown if rank is None else rank.otherwise(unknown)


def classify(c: Column | str, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """First matching ``(regex, label)`` rule wins."""
    value = col(c)
    out = None
    for pattern, label in rules:
        hit = value.rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


# -- hashes and keys ----------------------------------------------------------------------------

def content_fingerprint(c: Column | str) -> Column:
    """sha256 after long digit runs and whitespace runs are neutralised."""
    text = F.regexp_replace(col(c), r"(?U)\d{6,}", "#")
    return F.sha2(fold_ws(text), 256)


def canonical_hash(fields: dict[str, Column]) -> Column:
    """First 16 hex digits of sha256 over key-sorted compact JSON (nulls kept)."""
    payload = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.substring(F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256), 1, 16)


@F.pandas_udf(T.StringType())
def _nfkc_casefold(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v).casefold())


def name_key(c: Column | str) -> Column:
    """Comparison key: NFKC, folded whitespace, case folded.  ASCII rows never leave the JVM."""
    value = col(c)
    ascii_only = value.rlike(r"\A[\x00-\x7f]*\z")
    return fold_ws(F.coalesce(F.when(ascii_only, F.lower(value)), _nfkc_casefold(F.when(~ascii_only, value))))


def aliases_for(c: Column | str) -> Column:
    """Spelling variants of a name: without whitespace, with half-width parentheses."""
    name = col(c)
    variants = F.array(squeeze(name), F.translate(name, "（）", "()"))
    kept = F.filter(variants, lambda v: (v != "") & (v != name))
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))


def ascii_slug(c: Column | str, fallback: Column | str | None = None, empty: Column | str = "document") -> Column:
    """Fallback when given, else lower-case ASCII runs joined by ``-``, else ``empty`` (a hash-suffixed word)."""
    slug = F.btrim(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", "-"), F.lit("-"))
    blank = F.lit(empty) if isinstance(empty, str) else empty
    built = F.coalesce(F.nullif(slug, F.lit("")), blank)
    if fallback is None:
        return built
    return F.coalesce(F.nullif(col(fallback), F.lit("")), built)


# -- numerals -----------------------------------------------------------------------------------

def chinese_number(c: Column | str) -> Column:
    """一…九, 十, 十N, N十, N十M to an integer; anything else is null."""

    def digit(x: Column) -> Column:
        return F.when(F.length(x) == 1, F.nullif(F.position(x, F.lit(CJK_DIGITS)), F.lit(0)))

    def convert(text: Column) -> Column:
        head = F.split_part(text, F.lit("十"), F.lit(1))
        tail = F.regexp_extract(text, "^[^十]*十(.*)$", 1)
        tens = F.when(text.startswith("十"), F.lit(1)).otherwise(F.coalesce(digit(head), F.lit(0)))
        return F.when(text.contains("十"), tens * 10 + F.coalesce(digit(tail), F.lit(0))).otherwise(digit(text)).cast("int")

    return let(col(c), convert)


def numeral(c: Column | str) -> Column:
    """Arabic digits pass through, Chinese numerals are converted."""
    return let(col(c), lambda text: F.coalesce(F.when(text.rlike("^[0-9]+$"), text.try_cast("int")), chinese_number(text)))


def chapter_number(c: Column | str) -> Column:
    """Number of a ``第N章`` label; null for any other text."""
    return numeral(let(col(c), lambda text: extract_or_null(text, r"^第\s*([一二三四五六七八九十]+|[0-9]+)\s*章$")))


def appendix_number(c: Column | str) -> Column:
    return numeral(let(col(c), lambda text: extract_or_null(text, r"^附\s*录\s*([一二三四五六七八九十]+|[0-9]+)\s*(\S.*)$")))


# -- quoting and splitting ----------------------------------------------------------------------

def bounded_quote(c: Column | str, limit: int = MAX_QUOTE_CHARS) -> Column:
    """Verbatim prefix of at most ``limit`` characters, cut at the last clause mark when there is one."""
    text = col(c)
    prefix = F.substring(text, 1, limit)
    cut = rf"(?s)^(.+)[{CLAUSE_MARKS}]"
    at_clause = F.rtrim(F.regexp_extract(prefix, cut, 1), F.lit(CLAUSE_MARKS))
    return F.when(F.length(text) <= limit, text).when(prefix.rlike(cut), at_clause).otherwise(prefix)


def truncate_flag(c: Column | str, limit: int) -> Column:
    text = col(c)
    return F.struct(F.substring(text, 1, limit).alias("value"), (F.length(text) > limit).alias("truncated"))


def split_phrases(c: Column | str, separator: str = "；") -> Column:
    """Phrases between separators, folded, without a closing 。; empty ones dropped."""
    parts = F.transform(F.split(col(c), separator, -1), lambda p: F.trim(F.rtrim(fold_ws(p), F.lit("。"))))
    return F.filter(parts, lambda p: p != "")


def matches_code(c: Column | str, kind: str = "course", digits: str = FIVE_DIGITS) -> Column:
    """The whole text is a code; a major's has one digit more than a course's and may end in a capital."""
    return col(c).rlike({"course": rf"\A{digits}\z", "major": rf"\A[0-9]{digits}[A-Z]?\z"}[kind])


def is_iso_date(c: Column | str) -> Column:
    text = col(c)
    return text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")


def is_calendar_date(c: Column | str) -> Column:
    """ISO shaped and an existing day."""
    text = col(c)
    return F.coalesce(is_iso_date(text) & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))


# -- Markdown fragments -------------------------------------------------------------------------

_FRONT = r"(?s)\A---\n(.*?)\n---\n"
_ENTRY = "array<struct<k:string,v:string>>"


def _distinct_entries(entries: Column, others) -> Column:
    """Map of the entries none of whose ``others(entries, position)`` has the same key; most texts repeat no key."""

    def build(bound: Column) -> Column:
        kept = F.filter(bound, lambda e, i: ~F.exists(others(bound, i), lambda o: o.k == e.k))
        keys = F.transform(bound, lambda e: e.k)
        return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), bound).otherwise(kept))

    return let(entries, build)


def last_wins(entries: Column) -> Column:
    return _distinct_entries(entries, lambda bound, i: F.slice(bound, i + 2, F.size(bound)))


def first_wins(entries: Column) -> Column:
    return _distinct_entries(entries, lambda bound, i: F.slice(bound, F.lit(1), i))


def frontmatter_block(c: Column | str) -> Column:
    return F.regexp_extract(col(c), _FRONT, 1)


def parse_frontmatter(c: Column | str) -> Column:
    """Leading ``---`` block as a map; two-space continuation lines fold into the key above."""
    lines = F.filter(display_lines(frontmatter_block(c)), lambda line: strip_ws(line) != "")

    def step(acc: Column, line: Column) -> Column:
        last = F.element_at(acc, -1)
        folded = strip_ws(F.concat(last.v, F.lit(" "), strip_ws(line)))
        entry = F.struct(
            strip_ws(F.regexp_extract(line, r"(?s)^([^:]*):", 1)).alias("k"),
            F.btrim(strip_ws(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1)), F.lit('"')).alias("v"),
        )
        return (
            F.when(
                line.startswith("  ") & (F.size(acc) > 0),
                F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last.k.alias("k"), folded.alias("v")))),
            )
            .when(line.contains(":"), F.concat(acc, F.array(entry)))
            .otherwise(acc)
            .cast(_ENTRY)
        )

    return last_wins(F.aggregate(lines, F.array().cast(_ENTRY), step))


def frontmatter_list(c: Column | str, key: str) -> Column:
    """``key: [a, b]`` or an indented ``- a`` list; quotes and blanks stripped, empty items dropped."""
    raw = col(c)
    inline, nested = LIST_INLINE.replace("{key}", key), LIST_NESTED.replace("{key}", key)
    clean = lambda item: F.btrim(strip_ws(item), F.lit("'\""))
    inline_items = F.transform(F.split(F.regexp_extract(raw, inline, 1), ",", -1), clean)
    nested_items = F.transform(F.regexp_extract_all(F.regexp_extract(raw, nested, 1), F.lit(LIST_ITEM), F.lit(1)), clean)
    picked = F.when(raw.rlike(inline), inline_items).otherwise(nested_items)
    return F.filter(picked, lambda item: item != "")


def _pipe_cells(line: Column) -> Column:
    return F.transform(F.split(F.btrim(strip_ws(line), F.lit("|")), r"\|", -1), strip_ws)


def parse_meta_table(c: Column | str) -> Column:
    """First 字段 / 内容 table as a map; the last duplicate wins."""

    def rows_of(lines: Column) -> Column:
        at = F.array_position(lines, META_HEADER).cast("int")
        rest = F.slice(lines, at + 2, F.size(lines))
        stop = lambda r: F.array_position(F.transform(r, lambda line: line.startswith("|")), F.lit(False)).cast("int")
        rows = let(rest, lambda r: let(stop(r), lambda n: F.when(n > 0, F.slice(r, F.lit(1), n - 1)).otherwise(r)))
        return F.when(at > 0, rows).otherwise(F.array().cast("array<string>"))

    cells = F.filter(F.transform(let(F.transform(display_lines(c), strip_ws), rows_of), _pipe_cells), lambda x: F.size(x) >= 2)
    return last_wins(F.transform(cells, lambda x: F.struct(x[0].alias("k"), x[1].alias("v"))))


def table_fields(c: Column | str) -> Column:
    """Any pipe row of two or more cells as a map; the first duplicate wins, header and rule rows skipped."""
    rows = F.filter(display_lines(c), lambda line: line.startswith("|") & ~line.contains("---"))
    cells = F.filter(
        F.transform(rows, _pipe_cells),
        lambda x: (F.size(x) >= 2) & (x[0] != "") & ~x[0].isin(TABLE_HEADER_LABELS),
    )
    return first_wins(F.transform(cells, lambda x: F.struct(x[0].alias("k"), x[1].alias("v"))))


def heading_title(c: Column | str, default: str = "课程页") -> Column:
    pattern = r"(?m)^# (.*)$"
    text = col(c)
    return F.when(text.rlike(pattern), strip_ws(F.regexp_extract(text, pattern, 1))).otherwise(F.lit(default))


def blank_comments(c: Column | str) -> Column:
    """Closed ``<!-- -->`` comments reduced to their own newlines, so line numbers do not move."""
    pieces = F.regexp_extract_all(col(c), F.lit(r"(?s)(.*?)(<!--.*?-->|\z)"), F.lit(0))
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.concat(
                F.regexp_replace(p, r"(?s)<!--.*?-->\z", ""),
                F.regexp_replace(F.regexp_extract(p, r"(?s)<!--.*?-->\z", 0), r"[^\n]+", ""),
            ),
        ),
        "",
    )


# a fenced block: from its opening mark to the line that closes it, or to the end of the text
FENCED = (
    r"(?:(?dms)^ {0,3}(?<run>(?<mark>`|~)\k<mark>{2,}+)[^\n]*"
    r"(?:\n(?:.*?\n)?? {0,3}\k<run>[^\n]*(?=\n|\z)|.*\z))"
)
_HIDDEN = "\ufffe"  # a code point that is no character stands for a fenced line


def unfenced_lines(c: Column | str) -> Column:
    """Lines outside code fences with their original numbers: array of (line_no, text)."""

    def view(lines: Column) -> Column:
        pieces = F.regexp_extract_all(F.array_join(lines, "\n"), F.lit(rf"(?dms)(.*?)({FENCED}|\z)"), F.lit(0))
        closed = F.lit(FENCED + r"\z")
        hidden = lambda p: F.regexp_replace(F.regexp_extract(p, FENCED + r"\z", 0), r"(?dm)^[^\n]*$", _HIDDEN)
        shown = F.array_join(F.transform(pieces, lambda p: F.concat(F.regexp_replace(p, closed, F.lit("")), hidden(p))), "")
        numbered = F.transform(F.split(shown, "\n", -1), lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("text")))
        return F.when(F.size(lines) == 0, F.slice(numbered, 1, 0)).otherwise(F.filter(numbered, lambda x: x.text != _HIDDEN))

    return let(display_lines(c), view)


def visible_lines(c: Column | str) -> Column:
    """Reader-visible lines: comments blanked first, fenced lines dropped, original line numbers kept."""
    return unfenced_lines(blank_comments(c))


def unclosed_comment(c: Column | str) -> Column:
    """``struct(line_no, hides_content)`` of the first ``<!--`` without ``-->`` outside code fences.

    ``line_no`` is null when every comment closes.  ``hides_content`` looks at the original text, since an
    open comment also swallows fences that follow it.
    """
    text = col(c)

    def marker_line(view: Column) -> Column:
        # text before the open mark, closed comments reduced to their newlines
        kept = blank_comments(F.array_join(F.transform(view, lambda x: x.text), "\n"))
        before = F.substring_index(kept, "<!--", 1)
        nth = F.length(before) - F.length(F.translate(before, "\n", "")) + 1
        return F.when(kept.contains("<!--"), F.element_at(view, nth).line_no)

    def judge(line_no: Column) -> Column:
        hidden = F.exists(
            let(display_lines(text), lambda lines: F.slice(lines, line_no + 1, F.size(lines) + 1)),
            lambda line: strip_ws(line) != "",
        )
        return F.struct(
            line_no.alias("line_no"),
            F.when(line_no.isNotNull(), hidden).otherwise(F.lit(False)).alias("hides_content"),
        )

    return let(let(unfenced_lines(text), marker_line), judge)


def answer_label(question_type: Column | str, answer: Column | str) -> Column:
    """``struct(family, label)``: family by 选择 / 判断, label from the first answer line, null label = unparseable."""
    kind = col(question_type)
    first = F.split_part(col(answer), F.lit("\n"), F.lit(1))
    single = (
        r"(?U)^\s*[*#\s]*(?:正确)?答案[*\s]*[:：]\s*\**\s*([A-D])(?![" + MULTI_ANSWER_JOINERS + r"]*[A-D])"
    )
    judgement = r"(?U)^\s*[*#\s]*(?:参考|正确)?答案[*\s]*[:：]\s*\**\s*(正确|错误)"
    family = F.when(kind.contains("选择"), F.lit("single_choice")).when(kind.contains("判断"), F.lit("judgement"))
    label = F.when(family == "single_choice", extract_or_null(first, single)).when(
        family == "judgement", extract_or_null(first, judgement)
    )
    return F.struct(family.alias("family"), label.alias("label"))


def keyed_counts(c: Column | str) -> Column:
    """``normal`` / ``transition`` / ``total`` counts from a comment, a table cell or frontmatter."""
    text = col(c)
    payload = F.coalesce(extract_or_null(text, COUNT_COMMENT), extract_or_null(text, COUNT_CELL))
    zero = F.lit(0).cast("bigint")

    def pick(key: str, group: int) -> Column:
        tagged = F.coalesce(extract_or_null(payload, COUNT_FIELD.replace("{key}", key)).cast("bigint"), zero)
        fallback = F.coalesce(extract_or_null(text, COUNT_FRONT, group).cast("bigint"), zero)
        return F.when(payload.isNotNull(), tagged).otherwise(fallback)

    normal, transition, total = pick("normal", 1), pick("transition", 2), pick("total", 3)
    whole = F.when(payload.isNotNull() & (total == 0), normal + transition).otherwise(total)
    return F.struct(normal.alias("normal"), transition.alias("transition"), whole.alias("total"))
