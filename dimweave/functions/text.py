"""Text codecs as column expressions: blank test, tokens, key=value and delimited lines.

Everything here is built from JVM-side functions, so decoding stays inside the Spark plan.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Java counts as whitespace, as the body of a regex class.
JAVA_WHITESPACE = (
    r"\t-\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000"
)
MAX_FIELD_INDEX = 1000

_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}


def empty_fields() -> Column:
    return F.create_map().cast("map<string,string>")


def is_blank(text: Column) -> Column:
    """NULL, empty, or whitespace only (a no-break space is not whitespace here)."""
    return text.isNull() | text.rlike(rf"\A[{JAVA_WHITESPACE}]*\z")


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in text)


def _class_body(separators: str | None) -> str:
    return JAVA_WHITESPACE if separators is None else _quote(separators)


def _separator_regex(separators: str | None) -> str:
    # An escaped single character takes the regex-free path of the JVM's split.
    if separators is not None and len(separators) == 1:
        return _quote(separators)
    return f"[{_class_body(separators)}]"


def split_tokens(text: Column, separators: str | None = "|") -> Column:
    """All tokens between any of the separator characters, empty ones kept.

    `separators` is a set of characters; None stands for whitespace.  The empty string has no
    tokens and NULL gives NULL.
    """
    if separators == "":
        return F.when(text == "", F.array().cast("array<string>")).when(
            text.isNotNull(), F.array(text)
        )
    tokens = F.split(text, _separator_regex(separators), -1)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(tokens)


def _regex_tokens(text: Column, pattern: str) -> Column:
    """Split on a regular expression and drop the empty tokens at the end."""
    tokens = F.split(text, pattern, -1)
    from_end = F.array_position(
        F.transform(F.reverse(tokens), lambda t: t != ""), True
    )
    kept = F.slice(tokens, F.lit(1), (F.size(tokens) - from_end + 1).cast("int"))
    return F.when(from_end > 0, kept).otherwise(F.array().cast("array<string>"))


def _check_separator(name: str, value: str) -> None:
    if not value or re.fullmatch(rf"[{JAVA_WHITESPACE}]*", value):
        raise ValueError(f"{name} must not be blank")


@dataclass(frozen=True)
class KeyValue:
    """`a=1|b=2` text.

    `pair_separators` is a set of characters, `field_separator` a substring.  A token counts
    when text stands before its first field separator; the last of several equal fields wins
    and keeps the first one's position.
    """

    pair_separators: str = "|"
    field_separator: str = "="
    encoding: str = "UTF8"

    def __post_init__(self) -> None:
        _check_separator("pair_separators", self.pair_separators)
        _check_separator("field_separator", self.field_separator)
        _check_separator("encoding", self.encoding)

    @classmethod
    def from_descriptor(cls, text: str) -> KeyValue:
        """Read `separator1`, `separator2` and `encoding` from JSON or Base64 of JSON."""
        node = parse_descriptor(text)
        return cls(
            _text_or(node, "separator1", "|"),
            _text_or(node, "separator2", "="),
            _text_or(node, "encoding", "UTF8"),
        )

    def accepts(self, line: Column) -> Column:
        """True where `decode` would give at least one field, tested on the raw line.

        A filter on the decoded map would be pushed below the decoding and evaluate it twice.
        """
        if set(self.pair_separators) & set(self.field_separator):
            return F.lit(False)
        chars, field = _class_body(self.pair_separators), _quote(self.field_separator)
        pattern = rf"(?:\A|[{chars}])(?!{field})[^{chars}]+?{field}"
        return F.coalesce(line.rlike(pattern), F.lit(False))

    def decode(self, line: Column) -> Column:
        """Ordered map of the fields; NULL and undecodable lines give the empty map."""
        separator = self.field_separator
        # A separator is never blank, so a token holding it is not blank either.
        tokens = F.filter(
            F.split(F.coalesce(line, F.lit("")), _separator_regex(self.pair_separators), -1),
            lambda t: F.instr(t, separator) > 1,
        )
        return F.map_from_entries(
            F.transform(
                tokens,
                lambda t: F.struct(
                    F.substring_index(t, separator, 1).alias("key"),
                    F.substr(t, F.instr(t, separator) + len(separator)).alias("value"),
                ),
            )
        )

    def field(self, line: Column, name: str) -> Column:
        """One field, without building the map; NULL where the line lacks it."""
        separator = self.field_separator
        tokens = F.filter(
            F.split(F.coalesce(line, F.lit("")), _separator_regex(self.pair_separators), -1),
            lambda t: F.startswith(t, F.lit(name)) & (F.instr(t, separator) == len(name) + 1),
        )
        start = F.lit(len(name) + len(separator) + 1)
        return F.substr(F.get(tokens, F.size(tokens) - 1), start)


@dataclass(frozen=True)
class Delimited:
    """Positional text: `fields` gives (name, index) pairs.

    Tokens beyond the last index and tokens without a name are dropped, short lines lack the
    tail, empty tokens stay as empty strings.  `regex_fallback` splits a line once more when no
    separator occurs in it, taking the separator as a regular expression.
    """

    fields: tuple[tuple[str, int], ...]
    separator: str | None = "|"
    encoding: str = "UTF8"
    regex_fallback: bool = False

    def __post_init__(self) -> None:
        if not self.fields:
            raise ValueError("empty schema")
        if any(not 0 <= index <= MAX_FIELD_INDEX for _, index in self.fields):
            raise ValueError(f"field indices must lie within 0 and {MAX_FIELD_INDEX}")

    @classmethod
    def of(cls, *names: str, **options) -> Delimited:
        """Fields named in the order of their tokens."""
        return cls(tuple((name, i) for i, name in enumerate(names)), **options)

    @classmethod
    def from_descriptor(cls, text: str, regex_fallback: bool = False) -> Delimited:
        """Read a JSON descriptor, plain or as Base64; unknown properties are ignored."""
        node = parse_descriptor(text)
        fields = tuple(
            (f.get("fieldKey"), int(f.get("fieldIndex", 0))) for f in node.get("schema") or ()
        )
        return cls(
            fields,
            _text_or(node, "separator", "|"),
            _text_or(node, "encoding", "UTF8"),
            regex_fallback,
        )

    def _names(self) -> list[str | None]:
        by_index = {index: name for name, index in self.fields}
        return [by_index.get(i) for i in range(max(by_index) + 1)]

    def tokens(self, line: Column) -> Column:
        """Tokens of the line, NULL where the line is blank."""
        text = F.when(~is_blank(line), line)
        tokens = F.split(text, _separator_regex(self.separator), -1)
        if self.separator == "":
            tokens = F.when(text.isNotNull(), F.array(text))
        if self.regex_fallback and self.separator is not None:
            tokens = F.when(F.size(tokens) == 1, _regex_tokens(text, self.separator)).otherwise(
                tokens
            )
        return tokens

    def accepts(self, line: Column) -> Column:
        """True where `decode` would give at least one field."""
        first = next(i for i, name in enumerate(self._names()) if name is not None)
        if first == 0 and not self.regex_fallback:
            return ~is_blank(line)
        return F.coalesce(F.size(self.tokens(line)) > first, F.lit(False))

    def decode(self, line: Column) -> Column:
        """Ordered map of the named tokens; a blank line gives the empty map."""
        names, tokens = self._names(), self.tokens(line)
        labels = F.array(*[F.lit(n).cast("string") for n in names])
        width = F.least(F.size(tokens), F.lit(len(names)))
        if all(n is not None for n in names):
            fields = F.map_from_arrays(
                F.slice(labels, F.lit(1), width), F.slice(tokens, F.lit(1), width)
            )
        else:
            pairs = F.arrays_zip(
                F.slice(labels, F.lit(1), width).alias("key"),
                F.slice(tokens, F.lit(1), width).alias("value"),
            )
            fields = F.map_from_entries(F.filter(pairs, lambda p: p["key"].isNotNull()))
        return F.coalesce(fields, empty_fields())

    def field(self, line: Column, name: str) -> Column:
        """One field, without building the map; NULL where the line lacks it."""
        tokens = self.tokens(line)
        found = [F.get(tokens, F.lit(i)) for i, n in enumerate(self._names()) if n == name]
        return F.coalesce(*reversed(found)) if found else F.lit(None).cast("string")

    def columns(self, line: Column) -> list[Column]:
        """One column per named token, NULL where a line is too short."""
        tokens = self.tokens(line)
        last = {name: index for name, index in sorted(self.fields, key=lambda f: f[1])}
        return [F.get(tokens, F.lit(i)).alias(name) for name, i in last.items()]


def _unescape(text: str) -> str:
    def plain(match: re.Match) -> str:
        body = match.group(1)
        if len(body) == 5:
            return chr(int(body[1:], 16))
        return _ESCAPES.get(body, body)

    return re.sub(r"\\(u[0-9a-fA-F]{4}|.)", plain, text, flags=re.DOTALL)


def parse_descriptor(text: str) -> dict:
    """JSON after undoing one level of backslash escapes, else Base64 of such JSON."""
    try:
        node = json.loads(_unescape(text), strict=False)
    except json.JSONDecodeError:
        try:
            node = json.loads(_unescape(base64.b64decode(text).decode("utf-8")), strict=False)
        except (binascii.Error, UnicodeDecodeError, json.JSONDecodeError) as e:
            raise ValueError("descriptor is neither JSON nor Base64 of JSON") from e
    if not isinstance(node, dict):
        raise ValueError("descriptor must be a JSON object")
    return node


def _text_or(node: dict, name: str, default: str) -> str:
    value = node.get(name, default)
    return value if isinstance(value, str) else json.dumps(value)


def decode_bytes(data: Column, charset: str = "UTF8") -> Column:
    """Text of a BINARY column; malformed bytes become U+FFFD.

    The JVM knows which charsets there are; one it does not know is an error."""
    charsets = SparkContext._active_spark_context._jvm.java.nio.charset.Charset
    try:
        name = charsets.forName(charset).name()
    except IllegalArgumentException as e:
        raise ValueError(f"unknown charset {charset!r}") from e
    if name == "UTF-8":
        return F.make_valid_utf8(data.cast("string"))
    return F.decode(data, charset)


def render(fields: Column) -> Column:
    """`k=v|k=v` text of a map, without escapes; a NULL value shows as `null`."""
    return F.array_join(
        F.transform(
            F.map_entries(fields),
            lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
        ),
        "|",
    )


def render_pair(key: Column, value: Column) -> Column:
    """`key=…&value=…` text of a raw key and what is stored for it."""
    return F.format_string("key=%s&value=%s", key, value)
