"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by patterns, with their places.  Each candidate's value is hashed, and the
hashes are counted over the whole corpus: in how many repositories (different texts; copies of one
text are one) and under how many owners a value occurs.  Values that many owners or very many
repositories hold are examples; another value of one owner looks live, one of a few owners is
shared.  The base patterns (assign, access, hex) are always reported.  The further patterns catch too
much by themselves, so of them only the values that are no examples are added and masked.

Places come from splitting a text at a pattern and adding up lengths, in code points, block by block
so that the work grows with the matches of a text and not with their square.  Counting
goes (value, owner) and (value, repository) first and (value) next, all with partial sums, so a value
that a third of all rows hold reaches no task whole.  The verdicts come back by a join on the value,
which adaptive execution can split.

Null and empty texts have no candidates.  A null owner counts as one owner of its own.  Repeated
rows count as rows of their own.  Rows are numbered when the candidates are written, so null or
repeated ids do no harm.  Columns other than the named ones are not read, except that `redact`
passes them through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import materialize

# Kind, pattern, group whose length counts, least length.  Maximal runs of access and
# hex letters carry their least length in the pattern, which finds the same runs in fewer matches.
BASE = [
    (
        "assign",
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        1,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
# Own choice: further forms of credentials.
ADDED = [
    ("bearer", r"[Bb]earer\x20+([A-Za-z0-9+/_.=-]{20,})", 1, 20),
    ("prefixed", r"(?:gh[pousr]_|xox[abprs]-|sk_live_|sk-|glpat-|AIza)[A-Za-z0-9_-]+", 0, 20),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    ("userinfo", r"://[^\s/:@]+:([^\s/:@]+)@", 1, 8),
    ("digits", r"[0-9]{13,}", 0, 13),
    ("mixed", r"[A-Za-z0-9+/_-]{24,}", 0, 24),
]
KINDS = [*BASE, *ADDED]
BASE_KINDS = {k for k, *_ in BASE}
OWNERS_OF_EXAMPLE = 3
REPOSITORIES_OF_EXAMPLE = 10
STRIDE = 256


def bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """`function` of a value that is computed once; as a plain expression it would be computed again
    for each element of a higher-order function around it."""
    return F.transform(F.array(value), function)[0]


def in_blocks(values: Column) -> Column:
    """An array in slices of STRIDE elements."""
    count = F.ceil(F.size(values) / STRIDE).cast("int")
    number = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(number, lambda b: F.slice(values, (b - 1) * STRIDE + 1, STRIDE))


def running_sums(values: Column) -> Column:
    """For an array of integers, the sums up to each of them: sums within blocks of STRIDE values,
    then what came before each block."""
    ints = F.array().cast("array<int>")

    def sums(part: Column, before: Column) -> Column:
        begin = F.struct(before.alias("at"), ints.alias("all"))
        return F.aggregate(
            part, begin,
            lambda done, x: F.struct(
                (done["at"] + x).alias("at"),
                F.concat(done["all"], F.array(done["at"] + x)).alias("all"),
            ),
        )["all"]

    def joined_up(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x))
        befores = F.concat(F.array(F.lit(0)), sums(totals, F.lit(0)))
        return F.flatten(F.zip_with(parts, F.slice(befores, 1, F.size(parts)), sums))

    return bound(bound(values, in_blocks), joined_up)


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of struct(at, rank, till, kind, value) of the matches that are long enough."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rank = [k for k, *_ in KINDS].index(kind)
    between = F.transform(F.split(text, pattern, -1), F.length)
    # running place: after each match, the code points of all pieces and matches so far
    steps = F.zip_with(
        F.slice(between, 1, F.size(found)), F.transform(found, F.length), lambda gap, n: gap + n
    )
    ends = running_sums(steps)
    rows = F.transform(
        F.arrays_zip(found.alias("found"), values.alias("value"), ends.alias("till")),
        lambda s: F.struct(
            (s["till"] - F.length(s["found"])).alias("at"),
            F.lit(rank).alias("rank"),
            s["till"].alias("till"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
        ),
    )
    long_enough = F.filter(rows, lambda s: F.length(s["value"]) >= least)
    # splitting costs a pass of its own, so only texts with a match take it
    empty = F.array().cast("array<struct<at:int,rank:int,till:int,kind:string,value:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), long_enough).otherwise(empty)


def candidates(docs: DataFrame, text_col: str, owner_col: str, keep: list[str]) -> DataFrame:
    """The rows with a number, `__owner`, `__repository` and all their candidates, `__found`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = F.concat(*(spans_of(text, *k) for k in KINDS))
    return docs.select(
        *(F.col(c) for c in keep),
        F.monotonically_increasing_id().alias("__row"),
        F.coalesce(F.concat(F.lit("="), F.col(owner_col).cast("string")), F.lit("")).alias(
            "__owner"
        ),
        F.xxhash64(text).alias("__repository"),
        F.sort_array(found).alias("__found"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: repositories and owners that hold it, over the whole corpus."""
    values = F.array_distinct(F.transform("__found", lambda s: s["value"]))
    held = found.select("__owner", "__repository", F.explode(values).alias("v")).select(
        "__owner", "__repository", F.sha2("v", 256).alias("value_sha256")
    )
    return held.groupBy("value_sha256").agg(
        F.count_distinct("__owner").alias("n_owners"),
        F.count_distinct("__repository").alias("n_repositories"),
    )


def verdict(
    n_owners: Column, n_repositories: Column, owners_of_example: int = OWNERS_OF_EXAMPLE,
    repositories_of_example: int = REPOSITORIES_OF_EXAMPLE,
) -> Column:
    """`example` for widely copied values, `live` for other ones of one owner, else `shared`."""
    copied = (n_owners >= owners_of_example) | (n_repositories >= repositories_of_example)
    return F.when(copied, "example").when(n_owners == 1, "live").otherwise("shared")


def judged(
    docs: DataFrame, keep: list[str], text_col: str = "text", owner_col: str = "source",
    owners_of_example: int = OWNERS_OF_EXAMPLE,
    repositories_of_example: int = REPOSITORIES_OF_EXAMPLE,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their candidates, written once, and per row what to report:
    `__spans` as sorted struct(at, rank, till, kind, verdict), of added kinds no examples."""
    found = materialize(candidates(docs, text_col, owner_col, keep), "secret-candidates")
    rated = materialize(
        ownership(found).select(
            "value_sha256",
            verdict(
                F.col("n_owners"), F.col("n_repositories"), owners_of_example,
                repositories_of_example,
            ).alias("verdict"),
        ),
        "secret-owners",
    )
    one = found.select("__row", F.explode("__found").alias("s")).select(
        "__row", "s.at", "s.rank", "s.till", "s.kind", F.sha2("s.value", 256).alias("value_sha256")
    )
    told = one.join(rated, "value_sha256").filter(
        F.col("kind").isin(*sorted(BASE_KINDS)) | (F.col("verdict") != "example")
    )
    spans = told.groupBy("__row").agg(
        F.sort_array(F.collect_list(F.struct("at", "rank", "till", "kind", "verdict"))).alias(
            "__spans"
        )
    )
    return found, spans


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"], s["till"])), ","
    )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    owners_of_example: int = OWNERS_OF_EXAMPLE,
    repositories_of_example: int = REPOSITORIES_OF_EXAMPLE,
) -> DataFrame:
    """Per row: id, counts of the base kinds, `base_sha256`, `spans`, and how many of the spans
    are live-looking (`n_live`) or widely copied (`n_example`)."""
    docs = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(owner_col).alias("owner")
    )
    found, spans = judged(
        docs, ["doc_id"], "text", "owner", owners_of_example, repositories_of_example
    )
    none = F.array().cast("array<struct<at:int,rank:int,till:int,kind:string,verdict:string>>")
    rows = found.select("doc_id", "__row").join(spans, "__row", "left").select(
        "doc_id", F.coalesce("__spans", none).alias("s")
    )
    base = F.filter("s", lambda s: s["kind"].isin(*sorted(BASE_KINDS)))

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("s", lambda s: s[field] == value)).cast("long")

    return rows.select(
        "doc_id",
        *(count("kind", kind).alias(f"n_{kind}") for kind, *_ in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("s")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each stretch of overlapping spans replaced by a mask that names the first.

    Each block of spans masks the piece of text from where the blocks before it reach to where it
    reaches itself, so a text is not copied at each span."""

    def piece(part: Column, reach: Column) -> Column:
        def step(own: Column, done: Column, s: Column) -> Column:
            mask = F.concat(F.lit("[REDACTED:"), s["kind"], F.lit(":"), s["verdict"], F.lit("]"))
            gap = F.substring(own, done["at"] - reach + 1, s["at"] - done["at"])
            return F.when(
                s["at"] >= done["at"],
                F.struct(s["till"].alias("at"), F.concat(done["out"], gap, mask).alias("out")),
            ).otherwise(
                F.struct(F.greatest(done["at"], s["till"]).alias("at"), done["out"].alias("out"))
            )

        begin = F.struct(reach.alias("at"), F.lit("").alias("out"))
        end = F.greatest(reach, F.array_max(F.transform(part, lambda s: s["till"])))
        return bound(
            F.substring(text, reach + 1, end - reach),
            lambda own: F.aggregate(
                part, begin, lambda done, s: step(own, done, s), lambda done: done["out"]
            ),
        )

    def reaches(parts: Column) -> Column:
        begin = F.array(F.lit(0))
        return F.aggregate(
            parts,
            begin,
            lambda done, p: F.concat(
                done,
                F.array(
                    F.greatest(
                        F.element_at(done, -1), F.array_max(F.transform(p, lambda s: s["till"]))
                    )
                ),
            ),
        )

    def pieces(parts: Column) -> Column:
        return bound(
            reaches(parts),
            lambda reach: F.concat(
                F.array_join(F.zip_with(parts, F.slice(reach, 1, F.size(parts)), piece), ""),
                F.substring(text, F.element_at(reach, -1) + 1, F.length(text)),
            ),
        )

    return bound(bound(spans, in_blocks), pieces)


def redact(
    docs: DataFrame, text_col: str = "text", owner_col: str = "source",
    owners_of_example: int = OWNERS_OF_EXAMPLE,
    repositories_of_example: int = REPOSITORIES_OF_EXAMPLE,
) -> DataFrame:
    """All rows and columns, with every reported span masked by its kind and verdict."""
    found, spans = judged(
        docs, docs.columns, text_col, owner_col, owners_of_example, repositories_of_example
    )
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(
        masked(F.col(text_col), F.col("__spans"))
    )
    rows = found.drop("__found", "__owner", "__repository").join(spans, "__row", "left")
    return rows.withColumn(text_col, text).select(*docs.columns)
