"""Lookup joins: decode a line, look its key up in a dimension, merge and render.

All joins are equi-joins on `dim_key` against a side with one row per key.  None of them
carries a broadcast hint: Spark broadcasts a dimension only when its size, estimated or
measured at run time, is under `spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles
both sides, see `join_unique`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dimweave.functions.fields import (
    format_key,
    is_null_hash,
    is_null_text,
    lookup_key,
    merge,
)
from dimweave.functions.text import (
    Delimited,
    KeyValue,
    decode_bytes,
    is_blank,
    render,
    render_pair,
)
from dimweave.session import configure

JOIN_TYPES = {"left_join": "left", "left": "left", "inner_join": "inner", "inner": "inner"}
ON_MISS = ("keep", "drop", "blank_row")
DIM_KINDS = ("kv", "hash")

_FIELDS, _KEY, _DIM = "__fields", "dim_key", "__dim"


def join_type(how: str) -> str:
    """`left` or `inner` from any accepted spelling, in any case."""
    try:
        return JOIN_TYPES[how.lower()]
    except (KeyError, AttributeError):
        raise ValueError(f"join type must be left_join or inner_join, not {how!r}") from None


def line_format(decode: str | KeyValue | Delimited) -> KeyValue | Delimited:
    if decode == "kv":
        return KeyValue()
    if isinstance(decode, (KeyValue, Delimited)):
        return decode
    raise ValueError("decode must be 'kv', a KeyValue or a Delimited")


def drop_blank_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    return lines.where(~is_blank(F.col(line)))


def decodable(lines: DataFrame, decode, line: str = "line") -> DataFrame:
    """Lines that decode to at least one field."""
    return lines.where(line_format(decode).accepts(F.col(line)))


def rejects(lines: DataFrame, decode, line: str = "line") -> DataFrame:
    """The complement of `decodable`: lines a lookup leaves out."""
    return lines.where(~line_format(decode).accepts(F.col(line)))


def text_of(lines: DataFrame, decode, line: str = "line") -> DataFrame:
    """Turn a BINARY line column into text by the format's charset, leave text alone."""
    if lines.schema[line].dataType.typeName() != "binary":
        return lines
    return lines.withColumn(line, decode_bytes(F.col(line), line_format(decode).encoding))


def join_unique(
    lines: DataFrame, side: DataFrame, on: list[str], how: str, within: Column | None = None
) -> DataFrame:
    """Join to a side with one row per `on` (and per `within`, a condition on a range).

    When both sides are shuffled, a hot key must be split over tasks.  Adaptive skew handling
    does so, but only where each side comes straight from an exchange of the join itself.  A
    side that was grouped by the same key would be joined as it lies; the hash as one more key
    makes Spark exchange it once more, which is little next to the lines.
    """
    names = {c: f"__r{i}" for i, c in enumerate(on)}
    side = side.withColumnsRenamed(names).withColumn("__rh", F.xxhash64(*names.values()))
    lines = lines.withColumn("__lh", F.xxhash64(*on))
    same = F.col("__lh") == F.col("__rh")
    for left, right in names.items():
        same = same & (F.col(left) == F.col(right))
    if within is not None:
        same = same & within
    return lines.join(side, same, how).drop("__lh", "__rh", *names.values())


@dataclass(frozen=True)
class Lookup:
    """What a lookup does, apart from where the dimension comes from.

    `on_miss` is `keep` (source fields only), `drop`, or `blank_row` (an empty line; for hash
    dimensions a miss is an empty hash and keeps the source fields).  It follows from `how`
    when not given.  With `blank_is_miss` an inner join drops stored values that are blank.
    """

    left_field: str
    key_expr: str
    decode: str | KeyValue | Delimited = "kv"
    dim_kind: str = "kv"
    how: str = "left_join"
    on_miss: str | None = None
    blank_is_miss: bool = True
    dim_separator1: str = "|"
    dim_separator2: str = "="
    line: str = "line"
    output: str = "enriched"

    def __post_init__(self) -> None:
        join_type(self.how)
        line_format(self.decode)
        if self.dim_kind not in DIM_KINDS:
            raise ValueError(f"dim_kind must be one of {DIM_KINDS}")
        if self.on_miss is not None and self.on_miss not in ON_MISS:
            raise ValueError(f"on_miss must be one of {ON_MISS}")
        if not self.left_field or not self.key_expr:
            raise ValueError("left_field and key_expr are required")

    @property
    def miss(self) -> str:
        if self.on_miss is not None:
            if self.on_miss == "blank_row" and self.dim_kind == "hash":
                return "keep"
            return self.on_miss
        return "drop" if join_type(self.how) == "inner" else "keep"

    @property
    def join(self) -> str:
        return "inner" if self.miss == "drop" else "left"

    def keyed(self, lines: DataFrame) -> DataFrame:
        """Decodable lines with their fields and lookup key."""
        if clash := {self.output, _KEY, self.stored} & {*lines.columns}:
            raise ValueError(f"lines have columns that the lookup makes: {sorted(clash)}")
        lines = text_of(lines, self.decode, self.line)
        fmt = line_format(self.decode)
        decoded = decodable(lines, self.decode, self.line).withColumn(
            _FIELDS, fmt.decode(F.col(self.line))
        )
        return decoded.drop(self.line).withColumn(
            _KEY, lookup_key(F.col(_FIELDS), self.left_field, self.key_expr)
        )

    def key_of(self, lines: DataFrame) -> tuple[DataFrame, Column]:
        """The lines as text and, taken from the key field only, their lookup key."""
        lines = text_of(lines, self.decode, self.line)
        value = line_format(self.decode).field(F.col(self.line), self.left_field)
        return lines, format_key(value, self.key_expr)

    def keys(self, lines: DataFrame, **extra: Column) -> DataFrame:
        """The distinct lookup keys of the lines, together with further columns.

        Reduced before the shuffle; only the key field is taken from a line.
        """
        lines, key = self.key_of(lines)
        return (
            decodable(lines, self.decode, self.line)
            .select(
                key.alias(_KEY),
                *[column.alias(name) for name, column in extra.items()],
            )
            .distinct()
        )

    @property
    def stored(self) -> str:
        """Name of the column a dimension holds its values in."""
        return "dim_fields" if self.dim_kind == "hash" else "dim_value"

    def counts(self, stored: Column) -> Column:
        """False where a stored value is treated as absent."""
        if self.miss == "drop" and self.dim_kind == "hash":
            return ~is_null_hash(stored)
        if self.miss == "drop" and self.blank_is_miss:
            return ~is_null_text(stored)
        return stored.isNotNull()

    def with_entry(self, frame: DataFrame) -> DataFrame:
        """Replace the stored value by its fields and their text, NULL where absent."""
        value = F.col(self.stored)
        fields = value
        if self.dim_kind == "kv":
            fields = KeyValue(self.dim_separator1, self.dim_separator2).decode(value)
        decoded = frame.withColumn("__decoded", F.when(self.counts(value), fields))
        fields = F.col("__decoded")
        entry = F.struct(fields.alias("fields"), render(fields).alias("text"))
        return decoded.withColumn(_DIM, F.when(fields.isNotNull(), entry)).drop(
            "__decoded", self.stored
        )

    def dimension(self, dim: DataFrame) -> DataFrame:
        """`(dim_key, entry)` decoded once per dimension row, absent values left out.

        Keeping them would not change a left join, but they would be shuffled for nothing.
        """
        rows = dim.select(_KEY, self.stored).where(self.counts(F.col(self.stored)))
        return self.with_entry(rows)

    def emit(self, joined: DataFrame) -> DataFrame:
        """Merge and render; `joined` has the fields and, NULL on a miss, the entry.

        Without a common field the merge is one text after the other, and the text of the
        entry is at hand.
        """
        own, entry = F.col(_FIELDS), F.col(_DIM)
        common = F.coalesce(
            F.arrays_overlap(F.map_keys(own), F.map_keys(entry["fields"])), F.lit(False)
        )
        text = F.when(common, render(merge(own, entry["fields"]))).otherwise(
            F.concat_ws("|", render(own), F.nullif(entry["text"], F.lit("")))
        )
        if self.miss == "blank_row":
            text = F.when(entry.isNull(), F.lit("")).otherwise(text)
        return joined.withColumn(self.output, text).drop(_FIELDS, _DIM, _KEY)


@dataclass(frozen=True)
class LookupOptions:
    """A lookup with its staleness bound (None: none) and batching, as `from_options` reads them.

    Every lookup takes one in the place of a `Lookup`, and of the rest what applies to it:
    `fresh_lookup_join` and `enrich_stream` the staleness bound and negative caching, lookups in a
    live store the keys of a request, `enrich_stream` the time between micro-batches."""

    lookup: Lookup
    ttl: int | None
    negative_cache: bool
    batch_size: int
    min_batch_ms: int


def as_lookup(lookup: Lookup | LookupOptions | None, options: dict) -> Lookup:
    if lookup is None:
        return Lookup(**options)
    if options:
        raise TypeError(f"a lookup is given already, besides {sorted(options)}")
    return lookup.lookup if isinstance(lookup, LookupOptions) else lookup


def one_per_key(dim: DataFrame, stored: str, unique: str) -> DataFrame:
    """The dimension with each key once, settled inside the plan that uses it.

    `fail` ends the job at a key that repeats, `latest` takes its row with the newest `updated`, of
    equal ones the one with the greatest value.  Values are aggregated by sorting them, so rows are dealt
    out first, for `latest` by time too: no task sorts a whole file, nor all rows of a key unreduced."""
    if unique == "fail":
        dim = dim.repartition(_KEY)
        first = dim.groupBy(_KEY).agg(F.count(F.lit(1)).alias("__n"), F.any_value(stored).alias(stored))
        said = F.concat(F.lit("dimension key occurs more than once: "), F.col(_KEY))
        # The value depends on the check, so that no optimizer leaves it out.
        checked = F.when(F.col("__n") > 1, F.raise_error(said)).otherwise(F.col(stored))
        return first.select(_KEY, checked.cast(dim.schema[stored].dataType).alias(stored))
    if unique == "latest":
        dim = dim.repartition(_KEY, "updated")
        value = F.col(stored)
        if dim.schema[stored].dataType.typeName() == "map":
            value = F.to_json(stored)
        newest = F.max_by(F.struct(stored), F.struct("updated", value)).alias("__newest")
        return dim.groupBy(_KEY).agg(newest).select(_KEY, F.col("__newest")[stored].alias(stored))
    raise ValueError("unique must be fail or latest")


def lookup_join(
    lines: DataFrame,
    dim: DataFrame | None,
    lookup: Lookup | LookupOptions | None = None,
    *,
    entries: DataFrame | None = None,
    dedup: bool = False,
    unique: str | None = None,
    seen: tuple[Observation, Observation] | None = None,
    **options,
) -> DataFrame:
    """Enrich each line from `dim`; other columns of `lines` pass through.

    `dim` is `(dim_key, dim_value)` or `(dim_key, dim_fields)` with one row per key, see
    `dimweave.sources.dims`.  It may be a batch table joined to a stream of lines.

    `dedup` first reduces the dimension to the distinct keys of the lines.  Rows are the same;
    it pays when the dimension is far larger than the keys in use, since the lines are then
    often joined to a small table without being shuffled.  Batch only.

    `unique` settles keys that repeat: `fail` (the job ends), `latest` (by a column `updated` of the
    dimension, ties to the greatest value).  Without it the caller answers for unique keys.

    `entries` takes the place of `dim`: what `lookup.dimension` made of one before, perhaps stored in
    buckets by key.  The distinct keys of the lines are then brought to it (as with `dedup`).

    `seen` observes the lines that are looked up (`rows`) and those that find a value (`matched`).
    """
    configure(lines.sparkSession)
    lookup = as_lookup(lookup, options)
    keyed = lookup.keyed(lines)
    if unique is not None:
        dim = one_per_key(dim, lookup.stored, unique)
    fields = lookup.dimension(dim) if entries is None else entries
    if dedup or entries is not None:
        fields = lookup.keys(lines).join(fields, _KEY)
    if seen is not None:
        keyed = keyed.observe(seen[0], F.count(F.lit(1)).alias("rows"))
    found = join_unique(keyed, fields, [_KEY], lookup.join)
    if seen is not None:
        found = found.observe(seen[1], F.count(_DIM).alias("matched"))
    return lookup.emit(found)


def raw_lookup(
    lines: DataFrame, dim: DataFrame, line: str = "line", output: str = "enriched"
) -> DataFrame:
    """Inner lookup with the whole line as key; emits `key=…&value=…`.

    Blank lines are dropped first; a stored empty value is emitted, a NULL one is a miss.
    """
    configure(lines.sparkSession)
    stored = dim.where("dim_value IS NOT NULL").select(
        F.col("dim_key").alias(line), F.col("dim_value").alias(_DIM)
    )
    joined = join_unique(drop_blank_lines(lines, line), stored, [line], "inner")
    return joined.withColumn(output, render_pair(F.col(line), F.col(_DIM))).drop(line, _DIM)
