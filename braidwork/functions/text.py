"""Column helpers for titles, ids and link targets. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TITLE_CHARS

# Namespaces and site names.
#: Namespaces that never name an article.
BLOCKED = ("category", "draft", "file", "help", "image", "mediawiki", "module", "portal", "special", "talk", "template", "user", "wikipedia", "wp")
#: Sitelinks that end in `wiki` without being encyclopedias.
NOT_ENCYCLOPEDIAS = "quote|source|books|news|versity|voyage|species|commons|data|media|meta"


def utrim(x: Column) -> Column:
    """Without Unicode white space at both ends (trim() knows only the plain space). The pattern tries every place of a text, so texts that
    begin and end with a visible ASCII character, which have nothing to lose, are left as they are."""
    seen = lambda c: c.between("!", "~")
    return F.when(seen(F.left(x, F.lit(1))) & seen(F.substring(x, -1, 1)), x).otherwise(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))


def capfirst(x: Column) -> Column:
    """First character in upper case, which may be longer; the rest as it is."""
    return F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, F.lit(2), F.char_length(x)))


def before_colon(x: Column) -> Column:
    return F.substring_index(x, ":", 1)


def after_colon(x: Column) -> Column:
    return F.substring(x, F.locate(":", x) + 1, F.char_length(x))


def in_blocked_namespace(x: Column) -> Column:
    return (F.locate(":", x) > 1) & F.translate(before_colon(x), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").isin(*BLOCKED)


def link_target(x: Column) -> Column:
    """Trimmed target, or null where it is empty or in a blocked namespace."""
    t = utrim(x)
    return F.when((t != "") & ~in_blocked_namespace(t), t)


def template_name(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"(?U)[\s_]+", " "))


def diagnostic(x: Column) -> Column:
    """Title for a diagnostic table: control characters as spaces, null where it is too long."""
    return F.when(F.char_length(x) <= TITLE_CHARS, F.translate(x, "\t\n\r\b", "    "))


def object_label(x: Column) -> Column:
    return utrim(F.translate(x, '\t\n\r"', "    "))


def spaced(x: Column) -> Column:
    """`&nbsp;` and `_` as spaces."""
    return F.translate(F.replace(x, F.lit("&nbsp;"), F.lit(" ")), "_", " ")


def is_qid(x: Column) -> Column:
    return utrim(x).rlike("^[Qq][0-9]+$")


def is_language_code(x: Column) -> Column:
    return x.rlike("^(simple|[a-z]{2,3}(-[a-z]+)*)$")


def is_encyclopedia(site: Column) -> Column:
    return site.endswith("wiki") & ~site.rlike(NOT_ENCYCLOPEDIAS)


def last_segment(iri: Column) -> Column:
    return F.substring_index(iri, "/", -1)


def resource_title(iri: Column) -> Column:
    """Title of a resource IRI in angle brackets; null where its escapes are not UTF-8. A plus sign stays one."""
    part = last_segment(F.regexp_replace(iri, "^<+|>+$", ""))
    title = F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    # the decoder puts a replacement character where bytes are no text
    broken = title.contains("\ufffd") & ~part.contains("\ufffd") & ~F.upper(part).contains("%EF%BF%BD")
    return F.when(~broken, F.translate(title, "_", " "))


def csv_quoted(x: Column) -> Column:
    return F.when(x.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)


def qid_number(x: Column) -> Column:
    return F.substring(x, F.lit(2), F.char_length(x)).try_cast("long")
