"""URL filters: rules on host and path, and Empirical-Bayes reputation of hosts.

Rules come first: the longest that fits decides. Where none fits, the host's
reputation does. Labelled pages give, per host, registered domain and suffix,
the number of bad outcomes; each level's rate is shrunk towards its parent's
through a beta-binomial prior whose strength is estimated, level by level, by
the method of moments over all of the level's groups. A level's posterior
variance includes its parent's, so that a host without labels is no surer than
its domain, and so on upwards. A page is blocked if the lower posterior bound
of its host's bad rate (mean less ``z`` standard deviations; the default holds
with a probability of 70 %) exceeds ``excess`` times the rate of all labelled
pages: hosts that are credibly worse than the whole.

A host's port does not belong to its domain; the suffix is its last label, or
its last two where ``suffixes`` lists them; the registered domain has one label
more; an address of digits is its own domain and suffix.

All of it is DataFrame functions. Rules meet distinct hosts by an equality join
on each of a host's endings, so their number is not limited. Pages are
aggregated to hosts before any shuffle of size; the one join back on the host
is between two plain exchanges, which adaptive execution splits where one host
holds a large share.

Defined results: a null URL, or one without ``://``, has an empty host and
path; of rules of one length the one with the longer host wins, then the
earlier; labels without a page or with a null outcome do not count, repeated
ones count each; with no labels at all the prior is even (one half) and nothing
is blocked by reputation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: (verdict, host, path): a rule fits its host and all subdomains where the page's path starts with the rule's.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
EXCESS = 1.0
#: The 70 % quantile of the normal distribution.
Z = 0.5244005127080407
# Public suffixes of two labels; others go by their last label. A parameter wherever they are used.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.sg", "com.tr", "com.tw", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PORT, _ADDRESS = r":[0-9]*$", r"^[0-9.]+$|^\["
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _levels(hosts: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """``hosts`` with their registered domain and suffix."""
    bare, two = F.regexp_replace("host", _PORT, ""), F.substring_index("bare", ".", -2)
    of_two = two.isin(*suffixes) if suffixes else F.lit(False)
    address = F.col("bare").rlike(_ADDRESS)
    hosts = hosts.withColumn("bare", bare)
    hosts = hosts.withColumn("domain", F.when(address, F.col("bare")).when(of_two, F.substring_index("bare", ".", -3)).otherwise(two))
    return hosts.withColumn("suffix", F.when(address, F.col("bare")).when(of_two, two).otherwise(F.substring_index("bare", ".", -1))).drop("bare")


def rules_of_hosts(hosts: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, rules): for hosts that rules fit, an array of (length, host_length, later, path, rule, verdict)."""
    spark = hosts.sparkSession
    table = spark.createDataFrame([(of_host, len(of_host + path), len(of_host), -i, path, of_host + path, what) for i, (what, of_host, path) in enumerate(rules)], "ending string, length int, host_length int, later int, path string, rule string, verdict string")
    longest = max((of_host.count(".") + 1 for _, of_host, _ in rules), default=1)
    endings = F.expr(f"transform(sequence(1, least(size(split(host, '[.]')), {longest})), i -> substring_index(host, '.', -i))")
    met = hosts.select("host", F.explode(F.array_distinct(endings)).alias("ending")).join(table, "ending")
    return met.groupBy("host").agg(F.collect_list(F.struct("length", "host_length", "later", "path", "rule", "verdict")).alias("rules"))


def _strength(groups: DataFrame, parent: Column) -> float:
    """The prior strength (a count of pseudo-outcomes) of groups (n, bad) around their parents' rates."""
    q = parent * (1 - parent)
    spread, expected, scale = groups.agg(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - parent, 2)), F.sum(q), F.sum(q * (F.col("n") - 1))).first()
    share = min(max((spread - expected) / scale, 1e-4), 0.5) if scale else 1e-4
    return 1 / share - 1


def host_reputation(hosts: DataFrame, labelled: DataFrame, z: float = Z, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[DataFrame, float]:
    """(host, bad_mean, bad_bound) for each of ``hosts`` from ``labelled`` (host, n, bad), distinct in host; and the rate of all labelled pages."""
    by_host = materialise(_levels(labelled, suffixes), "labelled-hosts")
    total = by_host.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    prior = (total[1] + 0.5) / (total[0] + 1)
    prior_var = prior * (1 - prior) / (total[0] + 2)

    def shrunk(n: Column, bad: Column, parent: Column, parent_var: Column, strength: float) -> tuple[Column, Column]:
        """Posterior mean and variance of a group of ``n`` outcomes below a parent."""
        mean = (bad + strength * parent) / (n + strength)
        return mean, mean * (1 - mean) / (n + strength + 1) + F.pow(strength / (n + strength), 2) * parent_var

    def level(groups: DataFrame, key: str, parent: Column, parent_var: Column) -> DataFrame:
        rate, var = shrunk(F.col("n"), F.col("bad"), parent, parent_var, _strength(groups, parent))
        return materialise(groups.select(key, rate.alias(f"{key}_rate"), var.alias(f"{key}_var")), f"{key}-rates")

    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    of_suffix = level(by_host.groupBy("suffix").agg(*sums), "suffix", F.lit(prior), F.lit(prior_var))
    of_domain = level(by_host.groupBy("domain", "suffix").agg(*sums).join(of_suffix, "suffix"), "domain", F.col("suffix_rate"), F.col("suffix_var"))
    strength = _strength(by_host.join(of_domain, "domain"), F.col("domain_rate"))

    known = _levels(hosts, suffixes).join(of_domain, "domain", "left").join(of_suffix, "suffix", "left").join(by_host.select("host", "n", "bad"), "host", "left")
    parent, parent_var = F.coalesce("domain_rate", "suffix_rate", F.lit(prior)), F.coalesce("domain_var", "suffix_var", F.lit(prior_var))
    mean, var = shrunk(F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0)), parent, parent_var, strength)
    return known.select("host", mean.alias("bad_mean"), (mean - z * F.sqrt(var)).alias("bad_bound")), prior


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, excess: float = EXCESS, z: float = Z, suffixes: tuple[str, ...] = SUFFIXES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, bad_bound for every page. ``labels`` is (page_id, bad boolean)."""
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    outcomes = labels.where("bad is not null").select("page_id", "bad")
    labelled = parsed.select("page_id", "host").join(outcomes, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = materialise(parsed.select("host").distinct(), "hosts")
    reputation, prior = host_reputation(hosts, labelled, z, suffixes)
    of_host = materialise(reputation.join(rules_of_hosts(hosts, rules), "host", "left").select("host", "bad_bound", "rules"), "reputation")
    wins = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["path"])))
    own = F.when(F.col("bad_bound") > excess * prior, "block").otherwise("allow")
    judged = parsed.join(of_host, "host").select("page_id", "host", "path", wins.alias("wins"), own.alias("own"), "bad_bound")
    return judged.select("page_id", "host", "path", F.col("wins.rule").alias("rule"), F.coalesce("wins.verdict", "own").alias("verdict"), "bad_bound")


def oracle_sql(rules: list[tuple[str, str, str]] = RULES, excess: float = EXCESS, z: float = Z, suffixes: tuple[str, ...] = SUFFIXES) -> str:
    """DuckDB SQL for the registered query: the same arithmetic over pages and labels."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = lambda r: f"((host = '{r[1]}' or ends_with(host, '.{r[1]}')) and starts_with(path, '{r[2]}'))"
    case = lambda value: "case " + " ".join(f"when {fits(r)} then '{value(r)}'" for r in longest) + " end"
    strength = lambda parent, source: f"(select case when sum({parent} * (1 - {parent}) * (n - 1)) > 0 then 1 / least(greatest((sum(n * pow(bad / n - {parent}, 2)) - sum({parent} * (1 - {parent}))) / sum({parent} * (1 - {parent}) * (n - 1)), 1e-4), 0.5) - 1 else 9999 end from {source})"
    ending = lambda k: f"array_to_string(string_split(bare, '.')[-{k}:], '.')"
    of_two = f"{ending(2)} in ({', '.join(repr(x) for x in suffixes)})"
    levels = lambda source: f"select * exclude (bare), case when regexp_matches(bare, '{_ADDRESS}') then bare when {of_two} then {ending(3)} else {ending(2)} end as domain, case when regexp_matches(bare, '{_ADDRESS}') then bare when {of_two} then {ending(2)} else {ending(1)} end as suffix from (select *, regexp_replace(host, '{_PORT}', '') as bare from {source})"
    mean = lambda parent: f"(bad + m * {parent}) / (n + m)"
    var = lambda parent, parent_var: f"{mean(parent)} * (1 - {mean(parent)}) / (n + m + 1) + pow(m / (n + m), 2) * {parent_var}"
    return f"""
with parsed as (
  select page_id, translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{_UPPER}', '{_LOWER}') as host, coalesce(regexp_extract(url, '{_URL}', 2), '') as path from pages
), counted as (
  select parsed.host, count(*)::double as n, sum(case when labels.quality = 0 or labels.toxic = 1 then 1 else 0 end)::double as bad
  from parsed join labels on parsed.page_id = labels.doc_id where labels.quality is not null and labels.toxic is not null group by parsed.host
), by_host as ({levels("counted")}
), total as (select coalesce(sum(n), 0) as n, coalesce(sum(bad), 0) as bad from by_host
), prior as (select p, p * (1 - p) / (n + 2) as pv from (select n, (bad + 0.5) / (n + 1) as p from total)
), s0 as (select suffix, sum(n) as n, sum(bad) as bad, any_value(p) as p, any_value(pv) as pv from by_host, prior group by suffix
), s as (select suffix, {mean("p")} as suffix_rate, {var("p", "pv")} as suffix_var from s0, (select {strength("p", "s0")} as m)
), d0 as (select domain, suffix_rate, suffix_var, sum(n) as n, sum(bad) as bad from by_host join s using (suffix) group by domain, suffix_rate, suffix_var
), d as (select domain, {mean("suffix_rate")} as domain_rate, {var("suffix_rate", "suffix_var")} as domain_var from d0, (select {strength("suffix_rate", "d0")} as m)
), h0 as (select n, bad, domain_rate from by_host join d using (domain)
), hosts as ({levels("(select distinct host from parsed)")}
), h as (
  select hosts.host, coalesce(n, 0) as n, coalesce(bad, 0) as bad, coalesce(domain_rate, suffix_rate, p) as parent, coalesce(domain_var, suffix_var, pv) as parent_var, m
  from hosts left join counted on hosts.host = counted.host left join d on d.domain = hosts.domain left join s on s.suffix = hosts.suffix, prior, (select {strength("domain_rate", "h0")} as m)
), r as (select host, {mean("parent")} - {z} * sqrt({var("parent", "parent_var")}) as bound from h)
select page_id, host, path, {case(lambda r: r[1] + r[2])} as rule,
  coalesce({case(lambda r: r[0])}, case when bound > {excess} * p then 'block' else 'allow' end) as verdict
from parsed join r using (host), prior
"""
