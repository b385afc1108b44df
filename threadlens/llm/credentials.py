"""Secret scans with corpus-wide ownership frequency.

Candidates are the base patterns' spans and strings that look like tokens
(known prefixes, or long mixed strings).  The hash of every candidate's value
is aggregated over the whole corpus by distinct repositories and owners.  A
value that several owners hold is a copied example; one that a single owner
holds and that looks random is live-looking.  Base spans always stay; a
token-like string becomes a span (kind ``token``) only if it is live-looking.
All work is DataFrame expressions, and only candidates are shuffled.

Span positions come from splitting a text at its matches: the lengths of the
pieces before and of the matches add up to the starts.

Defined cases: a null or empty text has no spans; a null repository or owner
counts as one of its own; repeated rows count once for repositories and owners
and each get their spans; an empty table gives an empty result; input columns
other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.shared import written

# The base patterns, with the group that is the value and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
#: Kinds in the order in which spans of one start are listed: name, pattern, value group, least length of the value.
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
#: Token-like strings: known prefixes and long runs; what is none of them: identifiers in five groups, words joined by hyphens after a prefix.
PREFIX = r"(?:gh[pousr]_|sk[-_]|xox[abprs]-|AIza|glpat-|eyJ)"
TOKEN = PREFIX + r"[A-Za-z0-9_.-]{16,}|[A-Za-z0-9+/_-]{24,}"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SLUG = r"^[a-z]+([-_.][a-z0-9]{1,9})+$"
#: A run without a prefix: its longest part between separators, digits and letters, changes of character class in hundredths of its length, bits a character.
TOKEN_PART, TOKEN_DIGITS, TOKEN_CHANGES, MIXED_ENTROPY, PLAIN_ENTROPY = 16, 2, 30, 3.8, 3.3
#: Owners that make a value a copied example; least entropy (bits a character) and length of a live-looking one.
EXAMPLE_OWNERS, LIVE_ENTROPY, LIVE_LENGTH = 3, 3.0, 12


def matches(text: Column, pattern: str) -> Column:
    """array of (start, end, string) of the leftmost non-overlapping matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern)
    rows = F.arrays_zip(pieces.alias("piece"), found.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("out"))
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["piece"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
        F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + F.length(x["piece"])).alias("start"),
            (acc["at"] + F.length(x["piece"]) + F.length(x["hit"])).alias("end"), x["hit"].alias("hit"))))).alias("out"))
    return F.aggregate(rows, start, step)["out"]


def _spans(text: Column, kind: str, order: int, pattern: str, group: int, least: int, seen: Column) -> Column:
    """array of (start, ord, end, kind, value) of one kind; texts without a match skip the work."""
    value = lambda hit: F.regexp_extract(hit, pattern, group) if group else hit
    spans = F.transform(matches(text, pattern), lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("ord"), m["end"].alias("end"), F.lit(kind).alias("kind"), value(m["hit"]).alias("value")))
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,value:string>>")
    return F.when(seen, F.filter(spans, lambda s: F.length(s["value"]) >= least)).otherwise(empty)


def entropy(value: Column) -> Column:
    """Bits per character of a string."""
    chars = F.split(value, "")
    n = F.length(value).cast("double")
    p = lambda c: (n - F.length(F.replace(value, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.filter(chars, lambda c: c != "")), F.lit(0.0), lambda a, c: a - p(c) * F.log2(p(c)))


def token_like(value: Column) -> Column:
    """Whether a match of TOKEN looks random: with a known prefix, or by its parts, digits, changes of class and entropy.

    Paths, slugs and names in mixed case are words between separators, with few
    digits and few changes between lower case, upper case and digits; the
    entropy asked for is what random strings of the same classes have.
    """
    n = F.length(value)
    count = lambda of: n - F.length(F.regexp_replace(value, of, ""))
    longest = F.array_max(F.transform(F.split(value, "[/_-]"), lambda p: F.length(p)))
    changes = F.length(F.regexp_replace(value, "[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x"))
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]")
    random = ((longest >= TOKEN_PART) & (count("[0-9]") >= TOKEN_DIGITS) & (count("[A-Za-z]") >= TOKEN_DIGITS) & (100 * changes >= TOKEN_CHANGES * n)
              & (entropy(value) >= F.when(mixed, F.lit(MIXED_ENTROPY)).otherwise(F.lit(PLAIN_ENTROPY))))
    known = value.rlike("^" + PREFIX) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(SLUG)
    return known | (random & ~value.rlike(UUID))


def candidates(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """``_id``, doc_id, repository, owner and candidate spans of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = {"assign": text.rlike(r"(?i)passw|secret|token|api_?key"), "access": F.contains(text, F.lit("AKIA")), "hex": text.rlike(HEX)}
    base = [_spans(text, kind, i, pattern, group, least, seen[kind]) for i, (kind, pattern, group, least) in enumerate(BASE)]
    more = F.filter(_spans(text, "token", len(BASE), TOKEN, 0, 16, text.rlike(TOKEN)), lambda s: token_like(s["value"]))
    return docs.select(
        F.monotonically_increasing_id().alias("_id"), F.col("doc_id"), F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"), F.concat(*base).alias("base"), more.alias("more"))


def ownership(found: DataFrame) -> DataFrame:
    """value hash -> distinct repositories and owners over the corpus, whether it is an example and whether it looks live."""
    each = found.select("repository", "owner", F.explode(F.concat("base", "more")).alias("s")).select(
        F.sha2("s.value", 256).alias("hash"), "repository", "owner", F.col("s.value").alias("value"))
    once = each.groupBy("hash", "owner", "repository").agg(F.min("value").alias("value"))
    owners = once.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.min("value").alias("value"))
    total = owners.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.min("value").alias("value"))
    random = (F.length("value") >= LIVE_LENGTH) & (entropy(F.col("value")) >= LIVE_ENTROPY)
    return total.select("hash", "repositories", "owners", (F.col("owners") >= EXAMPLE_OWNERS).alias("example"), ((F.col("owners") < EXAMPLE_OWNERS) & random).alias("live"))


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, base spans and all spans (start, ord, end, kind, value, repositories, owners, example, live) of every document."""
    found = written(candidates(docs, repository, owner), "secret-candidates")
    known = written(ownership(found), "secret-ownership")
    spans = found.where((F.size("base") > 0) | (F.size("more") > 0)).select(
        "_id", F.explode(F.concat("base", "more")).alias("s")).withColumn("hash", F.sha2("s.value", 256))
    judged = spans.join(known, "hash")
    covered = judged.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct(
        "s.start", "s.ord", "s.end", "s.kind", "s.value", "repositories", "owners", "example", "live"))).alias("all"))
    # a token inside a base span adds nothing
    base = F.filter("all", lambda s: s["ord"] < len(BASE))
    outside = lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))
    covered = covered.select("_id", F.filter("all", lambda s: (s["ord"] < len(BASE)) | (s["live"] & outside(s))).alias("all"))
    empty = F.array().cast(covered.schema["all"].dataType)
    return found.select("_id", "doc_id").join(covered, "_id", "left").select("doc_id", F.coalesce("all", empty).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op7_credential_ownership(docs: DataFrame) -> DataFrame:
    """doc_id, counts, digest and list of spans, and how many of them are copied examples or look live."""
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda kind: lambda s: s["kind"] == kind
    return scan(docs).select(
        "doc_id", *[count(of_kind(k)).alias(f"n_{k}") for k, *_ in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        count(lambda s: s["example"]).alias("n_example"), count(lambda s: s["live"]).alias("n_live"))
