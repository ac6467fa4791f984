"""URL allow and block lists in one trie over reversed host labels and path segments.

The trie is built on the driver from the rule list (at most ``MAX_RULES`` rules, checked) and sent with
the task closure.  A lookup walks the host's labels from the last one and, at every label that carries
rules, the path's segments; the deepest host wins, then the longest path.  A url that meets no rule gets
``default``.

Defined cases: a null url or one without ``://`` has empty host and path and meets no rule; a rule's path
must be a prefix of the url's path, so a url without a path meets no rule that ends in ``/``; repeated
rules count once, and two rules of one place with different verdicts are an error; an empty table gives no rows;
columns but page_id and url are not read, so pages may have a column named host or verdict.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import table

MAX_RULES = 100_000
#: Key of a rule's end beside the children; no label or segment, which are strings, is equal to it.
END = None
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def build_trie(rules) -> dict:
    """Nested dicts: host labels from the right; under "/" the path segments; (text, verdict) under END where a rule ends."""
    rules = set(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the trie is sent to every task and takes {MAX_RULES} at most")
    root: dict = {}
    for host, path, verdict in sorted(rules):
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault("/", {})
        for segment in path.split("/"):
            node = node.setdefault(segment, {})
        if node.get(END, ("", verdict))[1] != verdict:
            raise ValueError(f"both verdicts for {host}{path}")
        node[END] = (host + path, verdict)
    longest = max((len(s) for _, path, _ in rules for s in path.split("/")), default=0)
    return {"hosts": root, "longest": longest}


def _by_path(node: dict, segments: list[str], longest: int):
    """The longest rule path that is a prefix: full segments on the way, the rule's last piece a prefix of the url's."""
    best = None
    for segment in segments:
        for piece in range(min(len(segment), longest) + 1):
            end = node.get(segment[:piece], {}).get(END)
            if end:
                best = end
        node = node.get(segment)
        if node is None:
            break
    return best


def lookup(trie: dict, host: str, path: str):
    """(rule, verdict) of the longest match, or None."""
    best, node, segments = None, trie["hosts"], path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if "/" in node:
            best = _by_path(node["/"], segments, trie["longest"]) or best
    return best


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null: none met), verdict for every row."""
    trie = build_trie(rules)

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [lookup(trie, h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype="object")

    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.select("page_id", "host", "path", judge("host", "path").alias("j")).select(
        "page_id", "host", "path", "j.rule", "j.verdict"
    )


def op5_trie_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


OP5_SQL = r"""
with parts as (
  select page_id,
    case when url is null or instr(url, '://') = 0 then '' else
      translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*', 0),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as host,
    case when url is null or instr(url, '://') = 0 then '' else
      regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) end as path
  from pages),
ruled as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from ruled
"""
