"""Secret scans (native): find candidates in every text, then weigh each by who owns it across the corpus.

Candidates are the three base kinds and, as a wider net, long mixed tokens. Each candidate value is
hashed, and the hashes are counted corpus-wide by distinct repositories and owners. A value that many
owners (``example_owners``) or many repositories (``example_repositories``) hold is a widely copied example; a value that
few of both hold and that looks like key material is a live-looking credential. Wide tokens judged live become spans of the kind ``live``; base spans stay
whatever the verdict.

Positions come from the pieces between the matches of a pattern, summed up in order, so only texts
that hold a match are ever taken apart. Counting makes (hash, owner, repository) distinct before it
shuffles them, so a value that stands in a third of all rows costs one row per task; in the join back
to the candidates the candidates are the side that the adaptive skew split cuts.

Defined results: null and empty texts have no spans; null owners count as one owner; repeated rows are
judged one by one, also under one id, but are the same owner; equal spans of different kinds are all
listed; an empty table gives an empty table; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.shared import stored


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Fixed patterns of the base kinds; the value pattern gives the secret itself.
NAMES = "(?:" + "|".join(
    _either_case(w) for w in ("password", "passwd", "secret", "token", "api")) + "_?" + _either_case("key") + ")"
LEAD = NAMES + "[\"']?\\x20*[:=]\\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]+"
PATTERNS = {
    "assign": LEAD + VALUE,
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "live": "[A-Za-z0-9+/_-]{20,}",
}
BASE = ("assign", "access", "hex")
#: Parts of values that stand for a secret without being one.
PLACEHOLDERS = "(?i)example|sample|dummy|changeme|placeholder|your|xxxx|1234567|abcdef"


def _hits(text: Column, kind: str) -> Column:
    """The matches of a kind, each with the length of the text between it and the match before."""
    pattern = PATTERNS[kind]
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    none = F.array().cast("array<struct<kind:string,k:int,gap:int,found:string>>")
    return F.when(text.rlike(pattern), F.transform(F.filter(pairs, lambda x: x["found"].isNotNull()), lambda x, k: F.struct(
        F.lit(kind).alias("kind"), k.alias("k"), F.length(x["gap"]).alias("gap"), x["found"].alias("found"),
    ))).otherwise(none)


def candidates(docs: DataFrame, id: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """One stored row per input row: its number, id, owner, repository and matches, without the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.concat(*[_hits(body, kind) for kind in PATTERNS]).alias("hits"),
    ), "secrets")


def spans(found: DataFrame) -> DataFrame:
    """One row per candidate with start and end in code points and the hash of its value."""
    order = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = found.select("row", "id", "owner", "repository", F.explode("hits").alias("h")).select(
        "row", "id", "owner", "repository", "h.kind", "h.k", "h.gap", "h.found")
    size = F.length("found")
    hit = hit.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("end") - size)
    value = F.when(F.col("kind") == "assign", F.regexp_extract("found", f"^{LEAD}({VALUE})$", 1)).otherwise(F.col("found"))
    mixed = F.col("found").rlike("[0-9]") & F.col("found").rlike("[A-Za-z]")
    hit = hit.withColumn("value", value).where(
        F.when(F.col("kind") == "assign", F.length("value") >= 6).when(F.col("kind") == "live", mixed).otherwise(True))
    return hit.withColumn("hash", F.sha2("value", 256)).drop("k", "gap", "found")


def ownership(hit: DataFrame) -> DataFrame:
    """Per hash: how many owners and repositories hold it."""
    held = hit.select("hash", "owner", "repository").distinct()
    return held.groupBy("hash").agg(
        F.count_distinct("owner").alias("n_owners"), F.count(F.lit(1)).alias("n_repositories"))


def looks_live(value: Column) -> Column:
    letters = F.size(F.array_distinct(F.split(value, "")))
    return (
        (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (letters >= 8)
        & ~value.rlike(PLACEHOLDERS)
    )


def judged(hit: DataFrame, example_owners: int, example_repositories: int) -> DataFrame:
    """Candidates with the counts of their value and a verdict: example, live or weak.

    A wide token inside a base span is dropped, as the base span already tells of it.
    """
    known = hit.join(ownership(hit), "hash")
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories)
    verdict = F.when(copied, "example").when(looks_live(F.col("value")), "live").otherwise("weak")
    order = Window.partitionBy("row").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    base = F.col("kind") != "live"
    known = known.withColumn("verdict", verdict).withColumn(
        "ended", F.max(F.when(base, F.col("end"))).over(before)).withColumn(
        "begins", F.min(F.when(base, F.col("start"))).over(after))
    free = F.coalesce(F.col("ended") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("begins") >= F.col("end"), F.lit(True))
    return known.where(base | ((F.col("verdict") == "live") & free)).drop("ended", "begins")


def scan_secrets(
    docs: DataFrame, id: str = "doc_id", text: str = "text", owner: Column | None = None,
    repository: Column | None = None, *, example_owners: int = 3, example_repositories: int = 4,
) -> DataFrame:
    """One row per input row: ``id`` and ``spans``, a sorted array of all findings.

    The owner is the column ``source`` unless told otherwise; a repository is a source and a language.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    found = candidates(docs, id, text, owner, repository)
    rank = F.array_position(F.array(*[F.lit(k) for k in PATTERNS]), F.col("kind"))
    per_row = judged(spans(found), example_owners, example_repositories).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", rank.alias("rank"), "end", "kind", "value", "verdict", "n_owners", "n_repositories"))).alias("spans"))
    none = F.array().cast(per_row.schema["spans"].dataType)
    return found.select("row", "id").join(per_row, "row", "left").select(
        F.col("id").alias(id), F.coalesce("spans", none).alias("spans"))


def redacted(docs: DataFrame, id: str = "doc_id", text: str = "text", mark: str = "[redacted]", **options) -> DataFrame:
    """The rows with every live-looking credential of their id replaced by ``mark``; examples stay."""
    found = scan_secrets(docs, id, text, **options)
    live = found.select(F.col(id).alias("__s_id"), F.explode("spans").alias("s")).where(F.col("s.verdict") == "live")
    values = live.groupBy("__s_id").agg(F.collect_set("s.value").alias("__s_values"))
    # longer values first, so that a value inside another one does not break it up
    ordered = F.transform(F.sort_array(F.transform("__s_values", lambda v: F.struct(-F.length(v), v.alias("v")))), lambda x: x["v"])
    clean = F.aggregate(ordered, F.col(text), lambda t, v: F.replace(t, v, F.lit(mark)))
    both = docs.join(values, docs[id].eqNullSafe(values["__s_id"]), "left")
    return both.select(*[
        F.when(F.col("__s_values").isNull(), docs[c]).otherwise(clean).alias(c) if c == text else docs[c] for c in docs.columns])
