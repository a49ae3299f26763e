"""What the text codecs must do, in plain Python."""

from __future__ import annotations

JAVA_BLANKS = {
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680, *range(0x2000, 0x2007),
        *range(0x2008, 0x200B), 0x2028, 0x2029, 0x205F, 0x3000,
    ]
}


def blank(text):
    return text is None or all(c in JAVA_BLANKS for c in text)


def split(text, separators):
    if text is None:
        return None
    if text == "":
        return []
    chars = JAVA_BLANKS if separators is None else set(separators)
    tokens = [""]
    for c in text:
        if c in chars:
            tokens.append("")
        else:
            tokens[-1] += c
    return tokens


def decode_kv(text, pairs="|", field="="):
    fields = {}
    for token in split(text, pairs) or []:
        at = token.find(field)
        if at > 0:
            fields[token[:at]] = token[at + len(field) :]
    return fields


def decode_delimited(text, names, separators="|"):
    if blank(text):
        return {}
    found = {}
    for name, token in zip(names, split(text, separators), strict=False):
        if name is not None:
            found[name] = token
    return found


def render(fields):
    return "|".join(f"{k}={'null' if v is None else v}" for k, v in fields.items())
