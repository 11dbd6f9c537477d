"""Link monitoring: extraction, collection, probe outcomes, baseline diff, host rot, next baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_audit.findings import as_findings, rule_findings
from corpus_audit.functions import text as tx

# Link patterns, probe states, rot limits, recommendations.
MD_LINK = r"(?U)\[[^\]]*\]\((https?://[^\s)]+)\)"
BARE_URL = r"(?U)(?<![(\[])\bhttps?://[^\s)\]<>`\"'；]+"
OK, DEAD, INCONCLUSIVE = "ok", "dead", "inconclusive"
HEAD_REFUSED = [403, 405, 501]
ROT_MIN_URLS = 3
ROT_PERCENT = 60
RECOMMENDATION = {
    "went_dead": "🟡→🔴 (考纲链接失效：内容无可信来源支撑，降级至骨架级)",
    "content_changed": "🟢→🟡 (考纲内容变更：已校对内容需重新核对，降级至 AI 待校对)",
}


def extract(scoped: DataFrame, keys: list[str]) -> DataFrame:
    """Link occurrences of in-scope lines: (keys, line_no, section, url).

    Markdown links all count; a bare url counts once per line and only when no Markdown link of the line has
    it.  The whole decision is made on the line's own arrays, so no join or shuffle is involved.
    """
    found = F.transform(F.regexp_extract_all("text", F.lit(MD_LINK), F.lit(1)), tx.normalize_url)
    bare = F.transform(F.regexp_extract_all("text", F.lit(BARE_URL), F.lit(0)), tx.normalize_url)
    urls = F.concat(found, F.array_except(bare, found))
    return scoped.filter(F.col("in_scope") & F.col("text").contains("http")).select(
        *keys, "line_no", "section", F.explode(urls).alias("url")
    )


def collect(refs: DataFrame, authoritative_hosts: list[str], digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """One row per url: host, authority, occurrence count, and how many distinct codes, sections and files.

    One scan: every reference becomes one row per member, equal ones are combined before they move, and the totals
    are sums of those counts.  The member lists themselves are rows of ``url_members``: a url may be cited by any number
    of pages, so no per-url array is built.
    """
    per = refs.select("url", F.inline(_members(digits))).groupBy("url", "member", F.coalesce("value", F.lit("")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    given = lambda name: F.count_if((F.col("member") == name) & (F.col("value") != ""))
    host = tx.host_of("url")
    return per.groupBy("url").agg(
        # every reference gives one row of each member, blank or not
        F.sum(F.when(F.col("member") == "file", F.col("n"))).alias("n_refs"),
        given("code").alias("n_codes"), given("section").alias("n_sections"), given("file").alias("n_files"),
    ).select("url", host.alias("host"), host.isin(authoritative_hosts).alias("authoritative"), "n_refs", "n_codes", "n_sections", "n_files")


def _members(digits: str) -> Column:
    return F.array(
        F.struct(F.lit("code").alias("member"), tx.entity_code_from_path("path", digits).alias("value")),
        F.struct(F.lit("section").alias("member"), F.col("section").alias("value")),
        F.struct(F.lit("file").alias("member"), F.col("path").alias("value")),
    )


def url_members(refs: DataFrame, digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Distinct (url, member, value) with member ``code``, ``section`` or ``file``; blanks left out."""
    return refs.select("url", F.inline(_members(digits))).filter(F.coalesce("value", F.lit("")) != "").distinct()


def classify_probes(attempts: DataFrame) -> DataFrame:
    """Outcome per url from its attempts (url, attempt, method, http_code, error, content_hash, authoritative).

    The first attempt that is neither a network fault nor a refused HEAD decides; without one the url stays
    inconclusive.  A mergeable min-by, so attempts of one url combine before the shuffle.
    """
    refused = (F.col("method") == "HEAD") & F.col("http_code").isin(HEAD_REFUSED)
    decides = F.col("http_code").isNotNull() & ~refused
    verdict = F.min_by(
        F.when(decides, F.struct("http_code", "content_hash")), F.when(decides, F.col("attempt"))
    )
    last_fault = F.max_by(F.when(~decides, F.coalesce("error", F.lit("unreachable"))), F.when(~decides, F.col("attempt")))
    grouped = attempts.groupBy("url").agg(
        verdict.alias("v"), last_fault.alias("fault"), F.bool_or("authoritative").alias("authoritative")
    )
    code = F.col("v.http_code")
    ok = code < 400
    return grouped.select(
        "url",
        F.when(F.col("v").isNull(), F.lit(INCONCLUSIVE)).when(ok, F.lit(OK)).otherwise(F.lit(DEAD)).alias("status"),
        code.alias("http_code"),
        F.when(ok & F.col("authoritative"), F.col("v.content_hash")).alias("content_hash"),
        F.when(F.col("v").isNull(), F.col("fault")).otherwise(F.lit("")).alias("detail"),
        "authoritative",
    )


def change_of(
    status: Column, content_hash: Column, authoritative: Column, known: Column, old_status: Column, old_hash: Column
) -> Column:
    """new / went_dead / recovered / content_changed in this precedence; inconclusive never triggers."""
    return (
        F.when(~known, F.lit("new"))
        .when((status == DEAD) & (old_status == OK), F.lit("went_dead"))
        .when((status == OK) & (old_status == DEAD), F.lit("recovered"))
        .when(authoritative & (status == OK) & (content_hash != old_hash), F.lit("content_changed"))
    )


def diff(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Current probes (url, status, http_code, content_hash, authoritative) with their change."""
    old = baseline.select(
        "url", F.col("status").alias("baseline_status"), F.col("content_hash").alias("baseline_hash"), F.lit(True).alias("_known")
    )
    change = change_of(
        F.col("status"), F.col("content_hash"), F.col("authoritative"), F.col("_known").isNotNull(),
        F.col("baseline_status"), F.col("baseline_hash"),
    )
    return (
        current.join(old, "url", "left")
        .withColumn("change", change)
        .withColumn("host", tx.host_of("url"))
        .drop("_known")
    )


def rotten(total: Column, dead: Column, min_urls: int = ROT_MIN_URLS, percent: int = ROT_PERCENT) -> Column:
    """Integer form of dead / total >= percent, with both minima."""
    return (total >= min_urls) & (dead >= min_urls) & (dead * 100 >= total * percent)


def bulk_rot(findings: DataFrame, min_urls: int = ROT_MIN_URLS, percent: int = ROT_PERCENT) -> DataFrame:
    """Hosts of which most urls are dead: (host, total, dead).  The dead urls are rows of ``findings``."""
    hosts = findings.groupBy("host").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == DEAD).alias("dead")
    )
    return hosts.filter(rotten(F.col("total"), F.col("dead"), min_urls, percent))


def actionable(findings: DataFrame, rot: DataFrame) -> DataFrame:
    """went_dead and content_changed urls with recommendation; ``in_bulk_host`` ones are reported per host."""
    hosts = rot.select("host", F.lit(True).alias("_rot"))
    advice = F.coalesce(*[F.when(F.col("change") == k, F.lit(v)) for k, v in RECOMMENDATION.items()])
    return (
        findings.filter(F.col("change").isin(list(RECOMMENDATION)))
        .join(hosts, "host", "left")
        .select("url", "host", "change", advice.alias("recommendation"), F.col("_rot").isNotNull().alias("in_bulk_host"))
    )


def next_baseline(current: DataFrame, prior: DataFrame) -> DataFrame:
    """State to persist: current urls only; an inconclusive probe keeps the prior status, code and hash."""
    old = prior.select("url", F.struct("status", "http_code", "content_hash").alias("_old"))
    keep = (F.col("status") == INCONCLUSIVE) & F.col("_old").isNotNull()
    new = F.struct("status", "http_code", "content_hash")
    return (
        current.join(old, "url", "left")
        .withColumn("_s", F.when(keep, F.col("_old")).otherwise(new))
        .select("url", "_s.status", "_s.http_code", "authoritative", "_s.content_hash")
    )


def next_members(refs: DataFrame, digits: str = tx.FIVE_DIGITS) -> DataFrame:
    """Codes and sections of the state to persist: (url, member, value) rows, always those of the current run."""
    return url_members(refs, digits).filter(F.col("member").isin("code", "section"))


def summary(findings: DataFrame) -> DataFrame:
    """One row of totals by status and by change."""
    statuses = [F.count_if(F.col("status") == s).alias(s) for s in (OK, DEAD, INCONCLUSIVE)]
    changes = [
        F.count_if(F.coalesce(F.col("change") == c, F.lit(False))).alias(f"n_{c}")
        for c in ("new", "went_dead", "recovered", "content_changed")
    ]
    return findings.agg(F.count(F.lit(1)).alias("total"), *statuses, *changes)


def official_snapshot(baseline: DataFrame, domain: str) -> DataFrame:
    """Authoritative entries inside the official domain (sort at the sink)."""
    return baseline.filter(F.col("authoritative") & tx.is_in_domain("url", domain))


def canonical_url_per_code(urls: DataFrame, codes: DataFrame) -> DataFrame:
    """Smallest url per code; ``codes(url, code)`` is the exploded code list."""
    return codes.join(urls.select("url"), "url").groupBy("code").agg(F.min("url").alias("url"))


def coherence(
    entries: DataFrame, codes: DataFrame, sections: DataFrame, catalog: DataFrame, digits: str = tx.FIVE_DIGITS
) -> DataFrame:
    """Findings on a baseline: status against http code, hash against authority, sections, catalogued codes.

    ``entries(url, status, http_code, authoritative, content_hash)``, ``codes(url, code)``,
    ``sections(url, section)``, ``catalog(code)``.
    """
    status, code = F.col("status"), F.col("http_code")
    sha = F.coalesce(F.col("content_hash").rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))
    present = F.col("content_hash").isNotNull()
    auth = F.col("authoritative")
    rules = [
        ("status_value", ~F.coalesce(status.isin(OK, DEAD, INCONCLUSIVE), F.lit(False)), status),
        ("ok_code", (status == OK) & ~F.coalesce(code.between(200, 399), F.lit(False)), code),
        ("dead_code", (status == DEAD) & ~F.coalesce(code.between(400, 599), F.lit(False)), code),
        ("inconclusive_code", (status == INCONCLUSIVE) & code.isNotNull(), code),
        ("hash_unexpected", ~auth & present, "content_hash"),
        ("hash_missing", auth & (status == OK) & ~sha, "content_hash"),
        ("hash_shape", auth & (status != OK) & present & ~sha, "content_hash"),
    ]
    rows = rule_findings(entries, "baseline", F.col("url"), rules)
    named = sections.filter(F.coalesce("section", F.lit("")) != "").select("url").distinct()
    bare = as_findings(entries.join(named, "url", "left_anti"), "baseline", "sections_empty", F.col("url"), "sections")
    shape = as_findings(codes.filter(~tx.matches_code("code", digits=digits)), "baseline", "code_shape", F.col("url"), F.col("code"))
    unknown = codes.filter(tx.matches_code("code", digits=digits)).join(catalog.select("code").distinct(), "code", "left_anti")
    unknown = as_findings(unknown, "baseline", "code_unknown", F.col("url"), F.col("code"))
    return rows.unionByName(bare).unionByName(shape).unionByName(unknown)


def set_equal(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Elements that are in one set only: (value, side); both empty when the sets are equal."""
    a, b = left.select(F.col(column).alias("value")).distinct(), right.select(F.col(column).alias("value")).distinct()
    return (
        a.join(b, "value", "left_anti").withColumn("side", F.lit("left_only"))
        .unionByName(b.join(a, "value", "left_anti").withColumn("side", F.lit("right_only")))
    )


def resolve_relative(page: Column, href: Column) -> Column:
    """Path of a relative href seen from a page path; ``.`` and ``..`` resolved, anchor and query cut."""
    target = F.regexp_replace(href, r"[?#].*$", "")
    folder = F.regexp_replace(page, r"[^/]*$", "")
    joined = F.when(target.startswith("/"), target).otherwise(F.concat(folder, target))
    parts = F.filter(F.split(joined, "/", -1), lambda p: ~p.isin("", "."))

    def step(acc: Column, part: Column) -> Column:
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(part == "..", up).otherwise(F.concat(acc, F.array(part)))

    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")


def broken_relative(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Relative links (page, href) whose target is no page path; absolute and mail links are not judged."""
    relative = links.filter(~F.col("href").rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:|//|#|$)"))
    targets = relative.withColumn("target", resolve_relative(F.col("page"), F.col("href")))
    return targets.join(pages.select(F.col("path").alias("target")).distinct(), "target", "left_anti")


def missing_edges(entities: DataFrame, key: str, kinds: list[str], edges: DataFrame) -> DataFrame:
    """Each page kind of an entity must link every other kind and never itself: (key, src, dst, problem).

    The expected graph is a literal list of kind pairs exploded per entity.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst")) for a in kinds for b in kinds if a != b])
    want = entities.select(key).distinct().select(key, F.inline(pairs))
    have = edges.select(key, "src", "dst").distinct()
    missing = want.join(have, [key, "src", "dst"], "left_anti").withColumn("problem", F.lit("missing"))
    loops = have.filter(F.col("src") == F.col("dst")).withColumn("problem", F.lit("self_link"))
    return missing.unionByName(loops)
