"""Column functions over text, numbers and identifiers. All stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille.functions import vocab

# Every whitespace character of Unicode, as a strip sees them.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def folded(c: Column) -> Column:
    return F.lower(strip(c))


def any_of(words: Sequence[str]) -> str:
    return "|".join(re.escape(w) for w in words)


# --- numbers ---------------------------------------------------------------------


def sql_round(c: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double; the result is never -0.0."""
    scale = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale + F.lit(0.0)


def exact_round(c: Column, digits: int) -> Column:
    """Round a non-negative double by its exact binary value, ties to even.

    ``c * scale`` may land on a half that the exact product misses. Splitting ``c``
    into two short parts gives the error of the product, whose sign breaks the tie.
    """
    scale = float(10**digits)

    def rounded(v: Column) -> Column:
        c, product = v["c"], v["product"]
        high = c * 134217729.0 - (c * 134217729.0 - c)
        error = (high * scale - product) + (c - high) * scale
        low = F.floor(product)
        tied = F.when(error > 0, low + 1).when(error < 0, low).otherwise(low + low % 2)
        tie = (product - low) == 0.5
        return F.when(tie, tied).otherwise(F.floor(product + 0.5)) / scale

    return let(F.struct(c.alias("c"), (c * scale).alias("product")), rounded)


def double_text(c: Column) -> Column:
    """Shortest text of a double: ``0.0002``, ``1e-05``, ``64.0``, ``1e+16``.

    Values of up to 15 digits are shown exactly; a longer one always reads back as the
    same value, but its last digit follows the JVM's.
    """
    size = F.abs(c)
    text = size.cast("string")
    # Most numbers are printed briefly by the JVM; only the others go through a lambda, which Spark interprets.
    body = (
        F.when(F.length(text) >= 17, let(F.struct(size.alias("size"), text.alias("text")), _shortest))
        .when(text.contains("E"), _shown(_power(text), _digits(text)))
        .otherwise(text)
    )
    return F.when(c < 0, F.concat(F.lit("-"), body)).otherwise(body)


def _power(exact: Column) -> Column:
    """The exponent of a number's text in scientific form."""
    return F.substring_index(exact, "E", -1).try_cast("int")


def _digits(exact: Column) -> Column:
    """The digits of a number's text in scientific form, without zeros at the end."""
    return F.rtrim(F.replace(F.substring_index(exact, "E", 1), F.lit("."), F.lit("")), F.lit("0"))


def _shown(power: Column, digits: Column) -> Column:
    """Plain from 1e-4 up to 1e16, with an exponent of at least two digits elsewhere."""
    rest = F.substring(digits, F.lit(2), F.length(digits))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    below = F.substring(digits, power + 2, F.length(digits))
    large = F.concat(whole, F.lit("."), F.when(below == "", F.lit("0")).otherwise(below))
    scientific = F.concat(
        F.substring(digits, 1, 1),
        F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(power).cast("string"),
    )
    return (
        F.when(power.between(-4, -1), small)
        .when(power.between(0, 15), large)
        .otherwise(scientific)
    )


def _shortest(value: Column) -> Column:
    """Text of a non-negative double, given it and the JVM's long text for it.

    The JVM may print more digits than it takes to read the same value back.
    """
    size, text = value["size"], value["text"]
    all_digits = F.replace(F.substring_index(text, "E", 1), F.lit("."), F.lit(""))
    place = lambda digits: (
        F.when(text.contains("E"), _power(text))
        .when(text.startswith("0."), F.length(digits) - F.length(all_digits))
        .otherwise(F.instr(text, ".") - 2)
    )

    def shortened(p: Column) -> Column:
        power, digits = p["power"], p["digits"]
        shown = F.when(text.contains("E"), _shown(power, F.rtrim(digits, F.lit("0")))).otherwise(text)
        for n in (17, 16, 15):
            up = (F.substring(digits, n + 1, 1) >= "5").cast("bigint")
            fewer = (F.substring(digits, 1, n).cast("bigint") + up).cast("string")
            same = F.concat(fewer, F.lit("E"), power - (n - 1)).try_cast("double") == size
            carried = power + F.length(fewer) - n
            shown = F.when((F.length(digits) > n) & same, _shown(carried, F.rtrim(fewer, F.lit("0")))).otherwise(shown)
        return shown

    parts = lambda digits: F.struct(place(digits).alias("power"), digits.alias("digits"))
    return let(F.ltrim(all_digits, F.lit("0")), lambda digits: let(parts(digits), shortened))


def number_of(text: Column) -> Column:
    """Double of a decimal number's text, blanks around it aside; NULL for anything else.

    The shape is tested first: a failed cast costs far more, and the JVM would also read
    suffixes such as ``10f``.
    """
    shape = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
    return let(strip(text), lambda bare: F.when(bare.rlike(shape), bare.try_cast("double")))


def render_param(name: str, c: Column) -> Column:
    """Text of a parameter value as the statistics show it.

    Accepts values that a load turned into doubles (48.0, 1.0) as well as typed ones.
    """
    if name in vocab.INT_PARAMS:
        return F.rint(c.cast("double")).cast("bigint").cast("string")
    if name in vocab.BOOL_PARAMS:
        truth = c.cast("boolean")
        return F.when(truth, F.lit("true")).when(~truth, F.lit("false"))
    if name in vocab.FLOAT_PARAMS:
        return double_text(c.cast("double"))
    return c.cast("string")


def asked_value(name: str, value: Column) -> Column:
    """A value as a user wrote it ('64.0', 'yes', '1.0'), in the rendered form."""
    if name in vocab.BOOL_PARAMS:
        word = folded(value)
        return (
            F.when(word.isin("1", "1.0", "true", "yes"), F.lit("true"))
            .when(word.isin("0", "0.0", "false", "no"), F.lit("false"))
            .otherwise(value)
        )
    if name in vocab.INT_PARAMS:
        whole = number_of(value).try_cast("bigint").cast("string")
        return F.coalesce(whole, value)
    return value


# --- relevance -------------------------------------------------------------------


def has_word(c: Column, words: Sequence[str]) -> Column:
    """True when ``c`` holds one of the words whole, with an optional plural s."""
    edge = r"[\p{L}\p{N}_]"
    return c.rlike(rf"(?<!{edge})(?:{any_of(words)})s?(?!{edge})")


def event_text(kind: Column, name: Column, messages: Column, topics: Column) -> Column:
    """Searchable text of an activity event: name, push messages and topics."""
    empty = F.array().cast("array<string>")
    # A message that is missing counts as an empty one.
    said = F.array_join(F.coalesce(messages, empty), " ", "")
    pushed = F.when(kind == "PushEvent", F.concat(F.lit(" "), said)).otherwise(F.lit(""))
    tagged = F.concat(F.lit(" "), F.array_join(F.coalesce(topics, empty), " "))
    return F.lower(F.concat(F.coalesce(name, F.lit("")), pushed, tagged))


def is_relevant(
    text: Column,
    wanted: Sequence[str] = vocab.TOPIC_WORDS,
    rejected: Sequence[str] = vocab.REJECT_WORDS,
) -> Column:
    return ~has_word(text, rejected) & has_word(text, wanted)


def is_off_topic(
    name: Column,
    description: Column,
    topics: Column,
    blocked: Sequence[str] = vocab.RADIO_TERMS,
    signals: Sequence[str] = vocab.TUNING_SIGNALS,
) -> Column:
    """A blocked term anywhere in the text, and no positive signal to override it."""
    text = F.lower(
        F.concat_ws(
            " ",
            *[F.nullif(c, F.lit("")) for c in (name, description)],
            F.nullif(F.array_join(topics, " "), F.lit("")),
        )
    )
    return text.rlike(any_of(blocked)) & ~text.rlike(any_of(signals))


# --- paths and identifiers -------------------------------------------------------


def file_category(path: Column) -> Column:
    """Category of a repository path, NULL for files that are not collected."""
    lower = F.lower(path)
    base = F.substring_index(lower, "/", -1)
    # The pattern's end may stand before a line break of two characters.
    ends = lambda words: F.right(lower, F.lit(max(map(len, words)) + 2)).rlike(rf"(?:{any_of(words)})$")
    holds = lambda c, words: reduce(Column.__or__, [c.contains(w) for w in words])
    category = F.when(ends(vocab.SKIP_SUFFIXES), F.lit(None).cast("string"))
    for name, files in vocab.NAMED_FILES.items():
        category = category.when(base.isin(*files), F.lit(name))
    return category.when(
        base.endswith(".py") & holds(base, vocab.SCRIPT_WORDS), F.lit("training_script")
    ).when(ends(vocab.CONFIG_SUFFIXES) & holds(lower, vocab.CONFIG_HINTS), F.lit("config"))


def base_model_of(tags: Column) -> Column:
    """Base model named by the first ``base_model:`` tag of a JSON tag list."""
    listed = F.from_json(tags, "array<string>")
    first = F.try_element_at(F.filter(listed, lambda t: t.startswith("base_model:")), F.lit(1))
    return F.regexp_replace(
        first, r"^base_model:(?:(?:finetune|adapter|quantized|merge):)?", ""
    )


def owner_of(full_name: Column) -> Column:
    """The part before the first slash, NULL without one."""
    return F.when(full_name.contains("/"), F.substring_index(full_name, "/", 1))


def name_part(full_name: Column) -> Column:
    return F.lower(F.substring_index(full_name, "/", -1))


def stable_uuid(key: Column) -> Column:
    """Version 5 UUID of a text key in the URL namespace."""
    namespace = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))
    digest = F.sha1(F.concat(namespace, F.encode(key, "UTF-8")))
    part = lambda start, size: F.substring(digest, start, size)
    variant = F.lower(
        F.hex(F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8))
    )
    return F.concat_ws(
        "-",
        part(1, 8),
        part(9, 4),
        F.concat(F.lit("5"), part(14, 3)),
        F.concat(variant, part(18, 3)),
        part(21, 12),
    )


# --- content ---------------------------------------------------------------------


def cap_bytes(c: Column, limit: int) -> Column:
    """The longest whole-character prefix of at most ``limit`` UTF-8 bytes."""
    raw = F.encode(c, "UTF-8")
    prefix = lambda n: F.substring(raw, 1, n).cast("string")
    cut = F.lit("")
    # A character has at most four bytes, so one of four cuts is on a boundary.
    for n in range(max(limit - 3, 0), limit + 1):
        cut = F.when(F.is_valid_utf8(prefix(n)), prefix(n)).otherwise(cut)
    return F.when(F.octet_length(c) > limit, cut).otherwise(c)


def text_of_base64(c: Column) -> Column:
    """Decode base64 text; broken input gives NULL, broken UTF-8 a replacement mark."""
    clean = F.regexp_replace(c, "[^A-Za-z0-9+/=]", "")
    return F.make_valid_utf8(F.try_to_binary(clean, F.lit("base64")).cast("string"))


def naive_time(c: Column) -> Column:
    """ISO-8601 text to a timestamp without zone; the zone suffix is dropped."""
    bare = F.regexp_replace(c, r"(?:Z|[+-]\d\d:?\d\d)$", "")
    shape = r"^\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d{1,6})?)?)?$"
    return F.when(bare.rlike(shape), bare).try_cast("timestamp_ntz")


def iso_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def scrub(c: Column, cap: int = 200) -> Column:
    """Cap an untrusted field and neutralise what could pass for an instruction."""
    text = F.substring(F.coalesce(c.cast("string"), F.lit("")), 1, cap)
    untagged = F.regexp_replace(text, vocab.CONTEXT_TAG, "")
    return F.regexp_replace(untagged, vocab.INSTRUCTION_SPAN, "[removed]")


def spaced_json(c: Column) -> Column:
    """Compact JSON text with a space after every comma and colon that is not in a string."""
    before = r'\G((?:"(?:[^"\\]|\\.)*+"|[^",:])*+)([,:])'
    return F.regexp_replace(c, before, "$1$2 ")


def json_list(c: Column) -> Column:
    """A column of JSON texts as lists of texts; text that is no JSON list stays as one item's text.

    Returns (items, raw): ``items`` NULL where the text is not a JSON list, ``raw`` the text then.
    """
    items = F.from_json(c, "array<string>")
    is_list = F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("ARRAY"), F.lit(False))
    return F.struct(F.when(is_list, items).alias("items"), F.when(~is_list, c).alias("raw"))


def text_length(c: Column) -> Column:
    """Characters of a text; 0 where there is none."""
    return F.coalesce(F.length(c), F.lit(0))


def json_length(c: Column) -> Column:
    """Length of a JSON array; an object counts as 0, bad JSON gives NULL."""
    parsed = F.try_parse_json(c)
    return F.when(parsed.isNotNull(), F.coalesce(F.json_array_length(c), F.lit(0)))


def contains_text(needle: str, *columns: Column) -> Column:
    """Case-insensitive match in any of the columns; % and _ keep their SQL meaning.

    A backslash in the needle stands for itself.
    """
    found = F.lit(False)
    needle = needle.replace("\\", "\\\\")
    for c in columns:
        found = found | F.coalesce(c, F.lit("")).ilike(f"%{needle}%")
    return found
