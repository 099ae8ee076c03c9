"""HTML to text, and text to lines.

Everything is a Catalyst expression over one row, so cleaning a page needs no
shuffle and no Python. Character classes are Unicode-aware (``(?U)``) wherever a
pattern meets Cyrillic words or no-break spaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dossierflow.functions import vocabulary as V

MARK = "\u0001"  # separator that page text cannot contain

NEWLINE = r"[\x0B-\r\x1C-\x1E\x85\u2028\u2029](?:(?<=\r)\n)?+"
# what may have to change in a text whose spaces are single
UNEVEN = r"[\t\x0B\f\r\x1C\x1D\x1E\x85\xA0[\u1680-\u3000&&[\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]]"
# the range before ``&&`` settles most characters with one comparison
GAPS = r"\t\u00A0[\u1680-\u3000&&[\u1680\u2000-\u200A\u202F\u205F\u3000]]"
SPACES = r"[ \t\n\r\f\x0B\u00A0\u1680\u2000-\u200A\u202F\u205F\u3000]"
SPACE_CHARS = " \t\n\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
BULLET = r"[•\-*]"

# every alternative starts with the same character, so other text fails at once
INVISIBLE = (
    r"(?is)<(?:!--.*?--|script(?:\s[^>]*)?>.*?</script\s*"
    r"|style(?:\s[^>]*)?>.*?</style\s*|noscript(?:\s[^>]*)?>.*?</noscript\s*)>"
)
_BLOCKS = "p|li|h[1-4]|dt|dd"
_HOLDERS = (
    "ul|ol|dl|div|table|thead|tbody|tfoot|tr|td|th|section|article|aside|nav|main|header|footer|form|fieldset|figure"
    "|blockquote|body|html"
)
BLOCK_TAG = rf"(?i)<(/?(?:{_BLOCKS}))(?:\s[^>]*|/)?>"
# a block tag, and then anything but its own end tag
NESTED = (
    rf"(?i)<({_BLOCKS})(?=[\s/>])[^<]*+(?:<(?!/?(?:{_BLOCKS})[\s/>])[^<]*+)*+(?:<(?!/\1[\s>])|\z)"
)
BLOCK_OR_HOLDER_TAG = rf"(?i)(</?(?:{_BLOCKS}|{_HOLDERS})(?:\s[^>]*|/)?>)"
# attribute values may hold angle brackets; quotes count after an equals sign only
QUOTED_ANGLE = r"""=\s*+(?:"[^"<>]*+[<>][^"]*+"|'[^'<>]*+[<>][^']*+')"""
WHOLE_TAG = r"""<[a-zA-Z](?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>"""
KEY_END = "\u0002"  # where the key of a pair ends
_HIDDEN_CLASS = r"""\s[^>]*class\s*=\s*["'][^"'>]*hidden-print[^"'>]*["'][^>]*>"""
HIDDEN_OPEN = r"(?i)(<[a-z][a-z0-9]*" + _HIDDEN_CLASS + ")"


def _balanced(tag: str, depth: int = 5) -> str:
    """Inside of an element up to its end tag, with same-tag nesting to ``depth``.
    Possessive throughout, so matching is linear and never recurses on length."""
    other = (
        r"[^<]++|<!--(?s:.*?)-->|<(?:script|style)\b(?s:.*?)</(?:script|style)\s*>"
        rf"|<(?!/?{tag}[\s/>])"
    )
    inside = f"(?:{other})*+"
    for _ in range(depth):
        inside = rf"(?:{other}|<{tag}(?=[\s/>]){inside}</{tag}\s*>)*+"
    return rf"{inside}</{tag}\s*>"


HIDDEN_ELEMENT = r"(?i)<([a-z][a-z0-9]*)" + _HIDDEN_CLASS + _balanced(r"\1")
DIV_ELEMENT = r"(?i)^<div(?=[\s/>])" + _balanced("div")


def literal_map(values: dict) -> Column:
    """A constant map column."""

    def sql(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return F.expr("map(" + ", ".join(f"{sql(k)}, {sql(v)}" for k, v in values.items()) + ")")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an intermediate value inside one expression, so it is computed once."""
    return F.aggregate(F.array(), value, lambda acc, _: acc, body)


FOLD_BLOCK = 256


def fold(
    items: Column, start: Column, step: Callable[[Column, Column], Column], grown: str,
    pack: Callable[[Column], Column] = lambda made: made,
) -> Column:
    """``aggregate`` whose state has a list field ``grown`` that starts empty and that
    ``step`` only appends to. Appending copies the list, so it grows block by block, and
    a long array does not cost its square. ``pack`` may shorten a block's list."""
    empty = F.array().cast("array<string>")

    def over(a: Column) -> Column:
        def block(s: Column, at: Column) -> Column:
            made = F.aggregate(F.slice(a, at, F.lit(FOLD_BLOCK)), s.withField(grown, empty), step)
            return let(made, lambda b: b.withField(grown, F.concat(s[grown], pack(b[grown]))))

        ends = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(FOLD_BLOCK))
        return F.aggregate(ends, start, block)

    return let(items, over)


def first(items: Column) -> Column:
    """First element, null when there is none."""
    return let(items, lambda a: F.get(a, F.lit(0)))


def strip(c: Column) -> Column:
    """Trim white space of raw text on both sides."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def trim(c: Column) -> Column:
    """Trim a part of normal text, where every white space is a plain one."""
    return F.trim(c)


def trim_lines(c: Column) -> Column:
    """Trim spaces and line ends of a part of normal text."""
    return F.btrim(c, F.lit(" \n"))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def any_of(words) -> str:
    """Regex alternation of literal words, longest first."""
    quoted = sorted((r"\Q" + w + r"\E" for w in words), key=len, reverse=True)
    return "(?:" + "|".join(quoted) + ")"


def beginnings(words) -> str:
    """Every character that can begin one of the words, whatever the case."""
    begins = {w[0].upper().lower() for w in words}
    able = (chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000)
    return "".join(c for c in able if c in begins or c.upper().lower() in begins or c.lower() in begins)


def any_case_of(words, pattern: str | None = None) -> str:
    """:func:`any_of` whatever the case, or a ``pattern`` that begins like the words. The class
    before it holds every character that can begin a word, so other places cost one test, not
    one per word."""
    starts = beginnings(words)
    return f"(?-i:(?=[{min(starts)}-{max(starts)}&&[{starts}]]))(?iu:{pattern or any_of(words)})"


def one_of(c: Column, words) -> Column:
    """Whether a text without bars is one of the words; in a lambda much cheaper than ``isin``."""
    return F.contains(F.lit("|" + "|".join(words) + "|"), F.concat(F.lit("|"), c, F.lit("|")))


def holds(text: Column, *parts: str) -> Column:
    """Whether a text holds any of the parts: a look at its bytes, far cheaper than a pattern."""
    found = F.contains(text, F.lit(parts[0]))
    for p in parts[1:]:
        found = found | F.contains(text, F.lit(p))
    return found


# --------------------------------------------------------------------------
# elements
# --------------------------------------------------------------------------
def first_element(rest: Column, tag: Column | str) -> Column:
    """Split markup that starts with an open ``tag`` at that element's end.

    Returns ``struct<element, tail>``. Nested elements of the same tag are
    counted with one fold over the text between tags; comments and scripts are
    stepped over. An element that is never closed runs to the end.
    """
    tag = F.lit(tag) if isinstance(tag, str) else tag
    pattern = F.concat(
        F.lit(r"(?is)(<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>)|(</?"),
        tag,
        F.lit(r"(?=[\s/>]))"),
    )
    pieces = F.split(F.regexp_replace(rest, pattern, F.lit("$1" + MARK + "$2")), MARK)
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end")
    )

    def step(state: Column, piece: Column) -> Column:
        opens = F.lower(F.left(piece, F.length(tag) + 1)) == F.concat(F.lit("<"), tag)
        closes = F.lower(F.left(piece, F.length(tag) + 2)) == F.concat(F.lit("</"), tag)
        depth = state.depth + F.when(opens, 1).when(closes, -1).otherwise(0)
        done = (state.end < 0) & closes & (state.depth == 1)
        return F.struct(
            depth.alias("depth"),
            (state.at + 1).alias("at"),
            F.when(done, state.at).otherwise(state.end).alias("end"),
        )

    def cut(parts: Column) -> Column:
        return let(
            F.aggregate(parts, start, step).end,
            lambda end: F.when(
                end < 0, F.struct(rest.alias("element"), F.lit("").alias("tail"))
            ).otherwise(
                F.struct(
                    F.concat(
                        F.array_join(F.slice(parts, F.lit(1), end), ""),
                        F.regexp_extract(F.get(parts, end), r"^</[^>]*>?", 0),
                    ).alias("element"),
                    F.concat(
                        F.regexp_replace(F.get(parts, end), r"^</[^>]*>?", ""),
                        F.array_join(F.slice(parts, end + 2, F.size(parts)), ""),
                    ).alias("tail"),
                )
            ),
        )

    return let(pieces, cut)


def div_element(rest: Column) -> Column:
    """The ``div`` element that ``rest`` starts with. One pattern covers ordinary
    pages; deeper nesting or an unclosed element takes the counting way."""
    found = F.regexp_extract(rest, DIV_ELEMENT, 0)
    return let(
        found, lambda e: F.when(e != "", e).otherwise(first_element(rest, "div").element)
    )


def drop_hidden(html: Column) -> Column:
    """Remove elements whose class list holds ``hidden-print``."""

    def visible(piece: Column) -> Column:
        tag = F.lower(F.regexp_extract(piece, r"^<([a-zA-Z][a-zA-Z0-9]*)", 1))
        return F.concat(F.lit("<!>"), first_element(piece, tag).tail)

    def deep(h: Column) -> Column:
        pieces = F.split(F.regexp_replace(h, HIDDEN_OPEN, MARK + "$1"), MARK)
        return F.array_join(
            F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(visible(p))), ""
        )

    marker = F.lit("hidden-print")
    return F.when(
        F.contains(html, marker),
        let(
            F.regexp_replace(html, HIDDEN_ELEMENT, "<!>"),
            lambda h: F.when(F.contains(h, marker), deep(h)).otherwise(h),
        ),
    ).otherwise(html)


# --------------------------------------------------------------------------
# cleaning
# --------------------------------------------------------------------------
def long_map(values: dict[str, str]) -> Column:
    """A constant map column of many entries: two literals, folded once."""
    return F.map_from_arrays(F.split(F.lit(MARK.join(values)), MARK), F.split(F.lit(MARK.join(values.values())), MARK))


def decode_entities(text: Column) -> Column:
    """Decode named and numeric character references, each exactly once.

    All names of HTML count; older ones also without a semicolon, unless a letter, a
    digit or ``=`` follows (so queries in links stay whole). Numbers need no
    semicolon; those that HTML forbids vanish, and impossible ones become U+FFFD.
    """
    known, bare = long_map(V.ENTITIES), long_map(V.BARE_ENTITIES)
    c1 = F.split(F.lit(MARK.join(V.C1_CHARACTERS)), MARK)

    def number(ref: Column) -> Column:
        is_hex = ref.rlike("^#[xX]")
        digits = F.regexp_extract(ref, "^#[xX]?0*+(.*)$", 1)
        short = F.when(F.length(digits) <= 7, digits)
        return F.when(is_hex, F.conv(short, 16, 10)).otherwise(short).try_cast("int")

    def code_point(ref: Column) -> Column:
        def character(code: Column) -> Column:
            valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
            forbidden = (
                code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
                | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
            )
            return (
                F.when(~F.coalesce(valid, F.lit(False)), "\ufffd")
                .when(forbidden, "")
                .when(code.between(128, 159), F.get(c1, code - 128))
                .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
            )

        return let(number(ref), character)

    pattern = (
        "^(?:(?:#[0-9]++|#[xX][0-9a-fA-F]++);?"
        "|[A-Za-z][A-Za-z0-9]*+(?:;|(?![A-Za-z0-9=])))"
    )

    def decoded(part: Column) -> Column:
        def replaced(ref: Column) -> Column:
            name = F.rtrim(ref, F.lit(";"))
            # names are looked up one by one in a map, so the most frequent have no part in it
            named = (
                F.when(ref == "nbsp;", "\u00a0").when(ref == "amp;", "&").when(ref == "quot;", '"')
                .when(ref == "lt;", "<").when(ref == "gt;", ">")
                .when(F.endswith(ref, F.lit(";")), F.element_at(known, name)).otherwise(F.element_at(bare, name))
            )
            return F.coalesce(
                F.concat(
                    F.when(ref.startswith("#"), code_point(name)).when(ref != "", named),
                    F.substr(part, F.length(ref) + 1),
                ),
                F.concat(F.lit("&"), part),
            )

        return let(F.regexp_extract(part, pattern, 0), replaced)

    parts = F.split(text, "&")
    return F.when(
        F.contains(text, F.lit("&")),
        F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), ""),
    ).otherwise(text)


def tidy(text: Column) -> Column:
    """White-space rules of the cleaned text: at most one blank line, no empty
    bullets, no line that only says OK."""
    t = F.replace(F.replace(text, F.lit("\u00a0"), F.lit(" ")), F.lit("\u200b"), F.lit(""))
    t = let(t, lambda x: F.when(holds(x, "  ", "\t"), F.regexp_replace(x, r"[ \t]{2,}", " ")).otherwise(x))
    # one line end stays one, several become two
    t = let(
        t,
        lambda x: F.when(
            holds(x, "\t", " \n", "\n "), F.regexp_replace(x, r"[ \t]?(\n)[ \t]?(?:(\n)[ \t\n]*)?", "$1$2")
        ).when(holds(x, "\n\n\n"), F.regexp_replace(x, r"\n\n\n++", "\n\n")).otherwise(x),
    )
    # no space is left before a line end
    t = let(t, lambda x: F.when(holds(x, "\n•\n"), F.regexp_replace(x, r"\n•[ \t\n]*\n", "\n")).otherwise(x))
    t = let(t, lambda x: F.when(holds(x, "OK"), F.regexp_replace(x, r"(?m)^OK$\n?", "")).otherwise(x))
    return F.btrim(t, F.lit(" \t\n"))


def _spellings(*names: str) -> list[str]:
    """Names of two letters in upper and lower case."""
    return sorted({a + b for n in names for a in (n[0], n[0].upper()) for b in (n[1], n[1].upper())})


def _block_text(piece: Column, at: Column) -> Column:
    """Text of one piece of markup; all but the first start with a block tag's name and ``>``."""

    def begins(*names: str) -> Column:
        found = F.startswith(piece, F.lit(names[0] + ">"))
        for n in names[1:]:
            found = found | F.startswith(piece, F.lit(n + ">"))
        return found

    def line(*parts) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    def text_of(markup: Column, gap: str, body: Callable[[Column], Column]) -> Column:
        plain = F.when(F.contains(markup, F.lit("<")), F.regexp_replace(markup, "<[^>]*>", gap)).otherwise(markup)
        return let(F.when(markup == "", "").otherwise(F.btrim(plain, F.lit(" \t\n"))), body)

    def or_line(t: Column, full: Column) -> Column:
        return F.when(t == "", "\n").otherwise(full)

    def outside(markup: Column) -> Column:
        return text_of(markup, "\n", lambda t: or_line(t, line("\n", t, "\n")))

    def ended(markup: Column) -> Column:
        last = F.when(begins(*("/" + n for n in _spellings("dt"))), "").otherwise("\n")
        return text_of(markup, "\n", lambda t: F.when(t == "", last).otherwise(line("\n", t, "\n")))

    def begun(markup: Column) -> Column:
        # inside a block tags separate words, elsewhere they separate lines
        def shown(t: Column) -> Column:
            return (
                F.when(begins("p", "P"), or_line(t, line("\n", t, "\n")))
                .when(begins(*_spellings("li")), or_line(t, line("\n• ", t, "\n")))
                .when(begins(*_spellings("dt")), line("\n", F.rtrim(t, F.lit(":")), ":"))
                .when(begins(*_spellings("dd")), or_line(t, line(" ", t, "\n")))
                .otherwise(or_line(t, line("\n\n", t, "\n")))
            )

        return text_of(markup, " ", shown)

    rest = F.substr(piece, F.instr(piece, ">") + 1)
    return (
        F.when(at == 0, outside(piece)).when(F.startswith(piece, F.lit("/")), let(rest, ended))
        .when(F.contains(piece, F.lit(">")), let(rest, begun)).otherwise(outside(piece))
    )


def quoted_angles(html: Column) -> Column:
    """Angle brackets inside attribute values as character references, so that every ``>``
    left ends a tag."""

    def inner(tag: Column) -> Column:
        values = F.substr(tag, F.lit(2), F.length(tag) - 2)
        return F.concat(F.lit("<"), F.replace(F.replace(values, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit(">"))

    parts = F.split(F.regexp_replace(html, WHOLE_TAG, MARK + "$0" + MARK), MARK)
    masked = F.transform(parts, lambda p, i: F.when((i % 2 == 1) & (F.length(p) > 2), inner(p)).otherwise(p))
    return F.when(html.rlike(QUOTED_ANGLE), F.array_join(masked, "")).otherwise(html)


def _flat_text(html: Column) -> Column:
    """Text of markup whose block elements hold no others."""
    pieces = F.split(F.regexp_replace(html, BLOCK_TAG + r"[ \t\n]*+", MARK + "$1>"), MARK)
    return F.array_join(F.transform(pieces, _block_text), "")


def _nested_text(html: Column) -> Column:
    """Text of any markup: the outermost of nested block elements takes all the text inside
    as one line. One pass over the block tags and the tags that hold them finds where
    an outermost element begins and ends: at its own end tag, where what holds it ends,
    or, of those that HTML lets stay open, at the next of its kind in the same holder."""
    pieces = F.split(F.regexp_replace(html, BLOCK_OR_HOLDER_TAG, MARK + "$1"), MARK)
    blocks = ["p", "li", "h1", "h2", "h3", "h4", "dt", "dd"]
    pair = ["dt", "dd"]

    def parsed(piece: Column, at: Column) -> Column:
        tag = F.when(at == 0, "").otherwise(F.lower(F.regexp_extract(piece, "^<(/?[a-zA-Z0-9]+)", 1)))
        end = F.when(at == 0, 0).otherwise(F.instr(piece, ">"))
        return F.struct(
            tag.alias("tag"), F.substr(piece, end + 1).alias("rest"),
            ((at > 0) & (F.substr(piece, end - 1, F.lit(1)) == "/")).alias("empty"),
        )

    def step(s: Column, p: Column) -> Column:
        closing = p.tag.startswith("/")
        holder = (p.tag != "") & ~F.ltrim(p.tag, F.lit("/")).isin(blocks) & ~p.empty
        begins = (s.tag == "") & p.tag.isin(blocks) & ~p.empty
        same = s.same + F.when((p.tag == s.tag) & ~p.empty, 1).when(p.tag == F.concat(F.lit("/"), s.tag), -1).otherwise(0)
        level = s.level + F.when(~holder, 0).when(closing, -1).otherwise(1)
        kin = (p.tag.isin("p", "li") & (p.tag == s.tag)) | (p.tag.isin(pair) & s.tag.isin(pair))
        follows = (s.level == 0) & kin & ~p.empty
        ends = (s.tag != "") & ((same == 0) | (level < 0))
        role = (
            F.when(begins, p.tag).when(follows, F.concat(p.tag, F.lit("+"), s.tag)).when(s.tag == "", "out")
            .when(ends, F.concat(F.lit("/"), s.tag)).otherwise("in")
        )
        fresh = begins | follows
        return F.struct(
            F.when(fresh, p.tag).when(ends, "").otherwise(s.tag).alias("tag"),
            F.when(fresh, 1).when(ends, 0).otherwise(same).alias("same"),
            F.when(fresh | ends | (s.tag == ""), 0).otherwise(level).alias("level"),
            F.concat(s.roles, F.array(role)).alias("roles"),
        )

    start = F.struct(
        F.lit("").alias("tag"), F.lit(0).alias("same"), F.lit(0).alias("level"),
        F.array().cast("array<string>").alias("roles"),
    )

    def shown(p: Column, role: Column) -> Column:
        gap = F.when((role == "out") | role.startswith("/"), "\n").otherwise(" ")
        text = F.btrim(F.regexp_replace(p.rest, "<[^>]*>", gap), F.lit(" \t\n"))

        before = F.when(role.endswith("+dt"), KEY_END).when(F.contains(role, F.lit("+")), "\n").otherwise("")
        kind = F.substring_index(role, "+", 1)

        def line(t: Column) -> Column:
            own = F.concat(F.lit("\n"), t, F.lit("\n"))
            return F.concat(
                before,
                F.when(role == "in", F.concat(F.when(p.tag == "/dt", KEY_END + " ").otherwise(" "), t))
                .when(kind.isin("p", "dt"), F.concat(F.lit("\n"), t))
                .when(kind == "li", F.concat(F.lit("\n• "), t))
                .when(kind == "dd", F.concat(F.lit(" "), t))
                .when(role == "/dt", F.concat(F.lit(KEY_END), F.when(t == "", "").otherwise(own)))
                .when(role.startswith("/"), F.concat(F.lit("\n"), own))
                .when(role == "out", own)
                .otherwise(F.concat(F.lit("\n\n"), t)),
            )

        return let(text, line)

    def joined(parts: Column) -> Column:
        roles = fold(parts, start, step, "roles").roles
        return let(
            roles,
            lambda r: F.array_join(F.transform(parts, lambda p, i: shown(p, F.get(r, i))), ""),
        )

    text = let(F.transform(pieces, parsed), joined)
    return F.regexp_replace(text, "[ \\t\\n:]*" + KEY_END, ":")


def clean_html(html: Column) -> Column:
    """Readable text of a page: headings as paragraphs, ``dt``/``dd`` as
    ``Key: Value``, list items as ``• item``, one blank line at most. The outermost of
    nested elements is one line."""
    h = let(
        F.coalesce(html, F.lit("")),
        lambda x: F.when(holds(x, "\r"), F.regexp_replace(x, r"\r\n?", "\n")).otherwise(x),
    )
    begun = ("<!", "<s", "<S", "<n", "<N")  # beginnings of all that is invisible
    h = let(h, lambda x: F.when(holds(x, *begun), F.regexp_replace(x, INVISIBLE, "<!>")).otherwise(x))
    h = let(let(h, quoted_angles), drop_hidden)
    text = let(h, lambda m: F.when(m.rlike(NESTED), _nested_text(m)).otherwise(_flat_text(m)))
    return tidy(let(text, decode_entities))


# --------------------------------------------------------------------------
# lines
# --------------------------------------------------------------------------
def normal_text(text: Column) -> Column:
    """Trimmed non-empty lines joined by newline, with plain single spaces; the
    input of all extractors."""

    def even(x: Column) -> Column:
        lines = F.regexp_replace(x, NEWLINE, "\n")
        # a single plain space stays as it is
        spaced = F.regexp_replace(lines, rf"[ {GAPS}](?:(?<! )|(?=[ {GAPS}]))[ {GAPS}]*+", " ")
        return F.when(F.contains(x, F.lit("  ")) | x.rlike(UNEVEN), spaced).otherwise(x)

    t = let(F.coalesce(text, F.lit("")), even)
    t = F.replace(F.replace(t, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    t = let(t, lambda x: F.when(F.contains(x, F.lit("\n\n")), F.regexp_replace(x, r"\n\n++", "\n")).otherwise(x))
    return trim_lines(t)


def lines_of(text: Column) -> Column:
    """Trimmed non-empty lines, in order."""
    return F.filter(F.split(normal_text(text), "\n"), lambda line: line != "")


def without_bullet(line: Column) -> Column:
    return F.regexp_replace(line, "^ *" + BULLET + " *", "")


# --------------------------------------------------------------------------
# lists
# --------------------------------------------------------------------------
def distinct_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """First item of every key, in order; sorts instead of comparing all pairs."""
    tagged = F.sort_array(
        F.transform(
            items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))
        )
    )
    firsts = let(
        tagged,
        lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1).k != e.k)),
    )
    in_order = F.sort_array(F.transform(firsts, lambda e: F.struct(e.i.alias("i"), e.x.alias("x"))))
    return F.transform(in_order, lambda e: e.x)


def runs(items: Column, key: Callable[[Column], Column]) -> Column:
    """Groups of neighbours with an equal key; sort ``items`` by the key first."""

    def build(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda e, i: F.when((i == 0) | (key(F.get(s, i - 1)) != key(e)), i)),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda a, j: F.slice(s, a + 1, F.coalesce(F.get(at, j + 1), F.size(s)) - a),
            ),
        )

    return let(items, build)


def comma_items(text: Column) -> Column:
    """Split on comma, semicolon, bullet or newline; null when nothing is left."""
    items = F.filter(
        F.transform(F.split(text, r"[,;•\n]+"), trim), lambda x: x != ""
    )
    return F.when(F.size(items) > 0, items)
