"""Text functions as column expressions: names, tokens, cuts, rewriting. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word character as Unicode letters, digits and underscore; Java's own class is ASCII only.
WORD = "\\p{L}\\p{N}_"


def stem(name: Column) -> Column:
    """File name without its last suffix; a leading dot or a trailing dot is no suffix."""
    return F.regexp_replace(name, "(?<=[^.])\\.[^./]+$", "")


def suffix(name: Column) -> Column:
    """Lower-cased last suffix with its dot, empty if there is none."""
    return F.lower(F.regexp_extract(name, "[^./](\\.[^./]+)$", 1))


def flatten_path(path: Column, root: str) -> Column:
    """Output name below ``root``: a direct child's stem, else the first folder and the rest joined by underscores."""
    prefix = root.rstrip("/") + "/"
    rel = F.substring(path, len(prefix) + 1, 1 << 30)
    parts = F.split(rel, "/", -1)
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "_")
    inside = F.when(F.size(parts) <= 1, stem(rel)).otherwise(F.concat(parts[0], F.lit("/"), stem(rest)))
    return F.when(path.startswith(prefix), inside).otherwise(stem(F.element_at(F.split(path, "/"), -1)))


def url_to_name(url: Column, longest: int = 100) -> Column:
    """A URL as a file name: no scheme, unsafe characters as single underscores."""
    name = F.regexp_replace(url, "^https?://", "")
    name = F.regexp_replace(name, f"[^{WORD}\\-.]", "_")
    return F.left(F.regexp_replace(name, "_+", "_"), F.lit(longest))


def hyphen_case(name: Column, longest: int = 64) -> Column:
    out = F.regexp_replace(F.lower(name), "(?U)[\\s_]+", "-")
    out = F.regexp_replace(out, "[^a-z0-9-]", "")
    return F.left(F.trim(F.regexp_replace(out, "-+", "-"), F.lit("-")), F.lit(longest))


def title_case(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("-"), F.lit(" ")))


def tokens(text: Column) -> Column:
    """Estimated tokens: a quarter of the characters, 1 at least, 0 for the empty text."""
    return F.when(F.length(text) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(text) / 4))).cast("int")


def rough_tokens(chars: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(chars / 4)).cast("int")


def truncate_tokens(text: Column, n: int) -> Column:
    return F.left(text, F.lit(4 * n))


class Estimate:
    """Tokens by the estimate, with the methods of :class:`tessera.functions.bpe.Tokens` that chunking asks for."""

    count = staticmethod(tokens)
    truncated = staticmethod(truncate_tokens)


def token_window(text: Column, start: int, n: int) -> Column:
    """Tokens [start, start + n) of the estimate's tokens of four characters; out of range is clamped."""
    return F.substring(text, 4 * max(start, 0) + 1, 4 * max(n, 0))


def section_text(text: Column, start: Column, end: Column) -> Column:
    return F.regexp_replace(F.substr(text, start + 1, F.greatest(end - start, F.lit(0))), "(?U)^\\s+|\\s+$", "")


def valid_chars(text: Column) -> Column:
    """Word characters, white space and common punctuation."""
    return F.length(F.regexp_replace(text, f"[^{WORD}\\s\\u00A0\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\u0085\\u001C-\\u001F.,!?;:'\"\\-]+", ""))


def needs_ocr(text: Column, least: int = 500) -> Column:
    return valid_chars(text) < least


def last_index(text: Column, what: str) -> Column:
    """0-based position of the last occurrence, -1 if there is none."""
    n = F.instr(F.reverse(text), what[::-1])
    return F.when(n > 0, F.length(text) - n - len(what) + 1).otherwise(F.lit(-1))


def paragraph_cut(text: Column, limit_chars: int, least: int = 100) -> Column:
    """Where to cut the first ``limit_chars`` characters: after the last blank line, else the last newline, else the
    last sentence end (full stop before exclamation before question mark), each only beyond ``least``; else the limit."""
    head = F.left(text, F.lit(limit_chars))
    out = F.length(head)
    for sep in ("? ", "! ", ". ", "\n", "\n\n"):
        at = last_index(head, sep)
        out = F.when(at > least, at + len(sep)).otherwise(out)
    return out.cast("int")


#: Fixed value: what a rewritten path prefix is, and where.
PATH_PREFIX = "(?:^|(?<=[\\s(/\"']))[\\w./\\-]+?(?=(?:factual|procedural|relational|meta)(?:/|$|\\s|\"|\\)|,))"


def rewrite_paths(text: Column) -> tuple[Column, Column]:
    """(text with path prefixes before the four class folders as ``skus/``, number of replacements)."""
    pattern = "(?U)" + PATH_PREFIX.replace("$", "(?:\\n?\\z)")
    return F.regexp_replace(text, pattern, "skus/"), F.regexp_count(text, F.lit(pattern))


_STRIP = "(?U)^\\s+|\\s+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _STRIP, "")


def compress_mapping(text: Column, longest: int = 30_000) -> Column:
    """Headers, descriptions and rules of a mapping file."""
    keep = F.filter(F.split(text, "\n", -1), lambda x: strip(x).startswith("#") | strip(x).startswith("**Description:**") | (strip(x) == "---"))
    out = F.array_join(keep, "\n")
    return F.when(F.length(out) > longest, F.concat(F.left(out, F.lit(longest)), F.lit("\n... (truncated)"))).otherwise(out)


def clean_mapping(text: Column, ids: Column, whole_words: bool = False) -> Column:
    """Lines that mention no deleted id. ``whole_words``: sku_100 doesn't count as a mention of sku_10."""
    def mentions(line):
        return F.arrays_overlap(F.split(line, "[^A-Za-z0-9_-]+"), ids) if whole_words else F.exists(ids, lambda i: F.contains(line, i))

    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~mentions(x)), "\n")


def extract_spec(text: Column) -> Column:
    """The first fenced markdown block, else the longest fenced block (the first of equals), else all; trimmed."""
    marked = F.regexp_extract_all(text, F.lit("(?s)```markdown\\s*\\n(.*?)```"), F.lit(1))
    blocks = F.regexp_extract_all(text, F.lit("(?s)```(?:\\w*)\\s*\\n(.*?)```"), F.lit(1))
    longest = F.element_at(F.filter(blocks, lambda b: F.length(b) == F.array_max(F.transform(blocks, lambda x: F.length(x)))), 1)
    return strip(F.when(F.size(marked) > 0, F.element_at(marked, 1)).when(F.size(blocks) > 0, longest).otherwise(text))


def front_matter_body(text: Column) -> Column:
    parts = F.split(text, "---", 3)
    return F.when(text.startswith("---") & (F.size(parts) >= 3), strip(F.element_at(parts, 3))).otherwise(text)


def repo_name(url: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, "github\\.com/([^/]+/[^/]+?)(?:\\.git)?/?$", 1), F.lit("")), F.lit("unknown_repo"))


#: Address patterns of the video sites and of repositories, over the lower-cased address.
VIDEO_A = ("youtube\\.com/watch", "youtu\\.be/", "youtube\\.com/embed/")
VIDEO_B = ("bilibili\\.com/video/", "b23\\.tv/", "bilibili\\.com/bangumi/")
REPO = ("github\\.com/[\\w-]+/[\\w-]+/?$", "github\\.com/[\\w-]+/[\\w-]+\\.git$")
REPO_PAGES = ("/issues", "/pull", "/blob/", "/tree/", "/releases", "/actions")
VIDEO_ID = ("youtube\\.com/watch\\?v=([^&]+)", "youtu\\.be/([^?]+)", "youtube\\.com/embed/([^?]+)")


def video_id(url: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in VIDEO_ID])


def clip_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, "(BV[a-zA-Z0-9]+)", 1), F.lit(""))


def strip_location_tokens(text: Column) -> Column:
    """OCR location marks removed; blank pages become null."""
    return F.nullif(strip(F.regexp_replace(text, "<\\|LOC_\\d+\\|>", "")), F.lit(""))


def clock_seconds(text: Column, sep: str = "[.,]") -> Column:
    """Seconds of an h:m:s.ms or h:m:s,ms clock."""
    p = f"(\\d+):(\\d+):(\\d+){sep}(\\d+)"
    g = lambda i: F.regexp_extract(text, p, i)
    n = lambda i: g(i).cast("double")
    return F.when(g(1) != "", n(1) * 3600 + n(2) * 60 + n(3) + n(4) / 1000)


def number_suffix(name: Column) -> Column:
    """The number after the first underscore of an id, null if there is none."""
    return F.split_part(name, F.lit("_"), F.lit(2)).try_cast("int")


def duration_seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def excerpt(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def word_match(label: Column, text: Column) -> Column:
    """The label stands in the lower-cased text as whole words."""
    quoted = F.regexp_replace(F.lower(label), "([^\\p{L}\\p{N}_])", "\\\\$1")
    return F.regexp_like(text, F.concat(F.lit("(?U)\\b"), quoted, F.lit("\\b")))
