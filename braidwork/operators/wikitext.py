"""Links in wiki text: brackets by a regular expression inside the JVM, templates by one Arrow UDF, since they nest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import link_target, utrim

BRACKETS = r"\[\[([^\[\]]*)\]\]"
_PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
TEMPLATE = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("positional", T.ArrayType(T.StringType())), T.StructField("named", T.ArrayType(_PAIR))]))
# Template names by what their arguments hold, and the parameters of citations that name articles.
#: A target in the first argument.
INTERLANGUAGE = {
    "ill", "illm", "ill-wd", "interlanguage link", "interlanguage link multi", "interwiki link",
    "link-interwiki",
}
#: A target in every argument.
HATNOTES = {
    "broader", "details", "further", "main", "see also",
}
#: A target in every other argument from the third on.
DISAMBIGUATIONS = {
    "about", "redirect", "redirect-distinguish", "redirect2",
}
#: Articles that a citation names.
CITED = [
    "title-link", "chapter-link", "author-link", "editor-link", "publisher-link",
    "subject-link", "contribution-link", "encyclopedia-link", "work-link",
]
#: A target in the second argument.
WORDS = {
    "l", "link", "ll", "l-self", "m", "m+",
    "mention", "m-self", "altform", "alt form", "alternative form of", "alternative spelling of",
    "form of", "infl of", "inflection of",
}
#: A target in the third argument.
ORIGINS = {
    "bor", "borrowed", "cal", "calque", "clq", "cog",
    "cognate", "der", "derived", "inh", "inherited", "lbor",
    "learned borrowing", "nc", "noncog", "obor", "orthographic borrowing", "phono-semantic matching",
    "psm", "semantic loan", "semi-learned borrowing", "sl", "slbor", "ubor",
    "unadapted borrowing",
}
#: A target in every argument from the second on.
WORD_LISTS = {
    "alt", "alter", "ant", "antonyms", "coordinate terms", "cot",
    "holo", "holonyms", "hyper", "hypernyms", "hypo", "hyponyms",
    "mero", "meronyms", "syn", "synonyms", "tropo", "troponyms",
    "af", "affix", "circumfix", "com", "compound", "con",
    "confix", "pre", "prefix", "suf", "suffix",
}
#: By template name: how many arguments come before the first target, the step to the next, whether there is a next.
ENCYCLOPEDIA = dict.fromkeys(INTERLANGUAGE, (0, 1, False)) | dict.fromkeys(HATNOTES, (0, 1, True)) | dict.fromkeys(DISAMBIGUATIONS, (2, 2, True))
DICTIONARY = dict.fromkeys(WORDS, (1, 1, False)) | dict.fromkeys(ORIGINS, (2, 1, False)) | dict.fromkeys(WORD_LISTS, (1, 1, True))

_PAIRS = re.compile(r"\{\{|\}\}")
_MARKS = re.compile(r"\{\{|\}\}|\[\[|\]\]|\||=")


def _cuts(body: str, mark: str, first: bool = False) -> list[int]:
    """Places of `mark` outside double braces and brackets."""
    braces = brackets = 0
    out = []
    for m in _MARKS.finditer(body):
        what = m[0]
        if what == "{{":
            braces += 1
        elif what == "}}":
            braces = max(braces - 1, 0)
        elif what == "[[":
            brackets += 1
        elif what == "]]":
            brackets = max(brackets - 1, 0)
        elif what == mark and not braces and not brackets:
            out.append(m.start())
            if first:
                break
    return out


def _template(body: str) -> tuple[str, list[str], list[str], list[str]] | None:
    """Name, positional arguments, names and values of the named ones."""
    flat = not ("{{" in body or "}}" in body or "[[" in body or "]]" in body)  # then every mark counts
    if flat:
        name, *args = body.split("|")
    else:
        at = [-1, *_cuts(body, "|"), len(body)]
        name, *args = (body[a + 1 : b] for a, b in zip(at, at[1:], strict=False))
    if not (name := name.strip()):
        return None
    positional, keys, values = [], [], []
    for arg in args:
        cut = [i] if flat and (i := arg.find("=")) >= 0 else [] if flat else _cuts(arg, "=", first=True)
        if cut:
            k = arg[: cut[0]].strip()
            if k and not (k.isascii() and k.isdigit()):
                keys.append(k)
                values.append(arg[cut[0] + 1 :].strip())
        else:
            positional.append(arg.strip())
    return name, positional, keys, values


def _templates(text: str | None) -> Iterator[tuple[str, list[str], list[str], list[str]]]:
    open_at = []
    for m in _PAIRS.finditer(text or ""):
        if m[0] == "{{":
            open_at.append(m.end())
        elif open_at and (made := _template(text[open_at.pop() : m.start()])) is not None:
            yield made


def templates(text: str | None) -> list[dict]:
    """Every template, inner ones before those around them; braces without a partner are passed over."""
    return [{"name": n, "positional": p, "named": [{"k": k, "v": v} for k, v in zip(ks, vs, strict=True)]} for n, p, ks, vs in _templates(text)]


#: Characters of text whose templates are handed over at once.
AT_ONCE = 1 << 22


def _columns(texts: list[str | None]) -> pa.Array:
    """templates() of each text, put together by columns."""
    names, positional, keys, values, each, ps, ks = [], [], [], [], [0], [0], [0]
    for text in texts:
        for n, p, k, v in _templates(text):
            names.append(n)
            positional += p
            keys += k
            values += v
            ps.append(len(positional))
            ks.append(len(keys))
        each.append(len(names))
    strings, offsets = lambda x: pa.array(x, pa.string()), lambda x: pa.array(x, pa.int32())
    named = pa.ListArray.from_arrays(offsets(ks), pa.StructArray.from_arrays([strings(keys), strings(values)], ["k", "v"]))
    made = pa.StructArray.from_arrays([strings(names), pa.ListArray.from_arrays(offsets(ps), strings(positional)), named], ["name", "positional", "named"])
    return pa.ListArray.from_arrays(offsets(each), made)


def _in_steps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        own, n = [], 0
        for text in batch:
            own.append(text.as_py())
            n += len(own[-1] or "")
            if n >= AT_ONCE:
                yield _columns(own)
                own, n = [], 0
        if own:
            yield _columns(own)


@F.arrow_udf(TEMPLATE)
def templates_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _in_steps(batches)


def with_templates(pages: DataFrame, text: str = "text") -> DataFrame:
    """One row for each template of each page: column t. Pages without braces never reach Python."""
    return pages.where(F.col(text).contains("{{")).withColumn("t", F.explode(templates_udf(F.col(text))))


def template_targets(template: Column, kind: str = "encyclopedia") -> Column:
    """array<string> of raw link targets of a template struct, in order."""
    from ..functions.text import template_name

    table = ENCYCLOPEDIA if kind == "encyclopedia" else DICTIONARY
    name, args = template_name(template["name"]), template["positional"]
    groups: dict[tuple, list[str]] = {}
    for n, how in table.items():
        groups.setdefault(how, []).append(n)
    none = F.array().cast("array<string>")
    full = lambda x: x != ""
    out = F.when(F.lit(False), none)
    for (skip, step, every), names in groups.items():
        if every:
            found = _from(args, skip, step)
        else:
            found = F.filter(F.array(F.get(args, F.lit(skip))), lambda x: x.isNotNull() & full(x))
        out = out.when(name.isin(names), found)
    if kind == "encyclopedia":
        value = lambda k: F.get(F.filter(template["named"], lambda e: e["k"] == k), F.lit(0))["v"]
        cited = F.filter(F.array(*[value(k) for k in CITED]), lambda x: x.isNotNull() & full(x))
        out = out.when(name.startswith("cite ") | (name == "citation"), cited)
    return out.otherwise(none)


def _from(args: Column, skip: int, step: int) -> Column:
    return F.filter(args, lambda x, i: (x != "") & (i >= skip) & (i % step == 0))


def bracket_targets(text: Column) -> Column:
    """array<string> of normalised targets of [[...]], with repeats; text inside that holds template braces is no link."""
    inner = F.filter(F.regexp_extract_all(text, F.lit(BRACKETS), F.lit(1)), lambda x: ~x.contains("{{") & ~x.contains("}}"))
    return F.filter(F.transform(inner, lambda x: link_target(F.substring_index(x, "|", 1))), lambda x: x.isNotNull())


def redirects(pages: DataFrame, trim: bool = False) -> DataFrame:
    """title, target of redirecting pages of namespaces 0 and 14."""
    as_is = utrim if trim else (lambda x: x)
    return pages.where("ns IN (0, 14) AND redirect IS NOT NULL").select(as_is(F.col("title")).alias("title"), as_is(F.col("redirect")).alias("target"))


def links(pages: DataFrame, kind: str = "encyclopedia", with_template_links: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """title, target of the other pages of these namespaces: brackets, then templates, with repeats. A target ends at a line break."""
    own = pages.where("ns IN (0, 14) AND redirect IS NULL")
    title = utrim(F.col("title")) if kind == "dictionary" else F.col("title")
    rows = own.select(*keep, title.alias("title"), F.explode(bracket_targets(F.col("text"))).alias("target"))
    if with_template_links:
        raw = with_templates(own).select(*keep, title.alias("title"), F.explode(template_targets(F.col("t"), kind)).alias("target"))
        rows = rows.unionByName(raw.withColumn("target", link_target(F.col("target"))).where("target IS NOT NULL"))
    first = F.substring_index("target", "\n", 1)
    return rows.withColumn("target", utrim(first) if kind == "dictionary" else first)


def first_pages(pages: DataFrame, most: int) -> DataFrame:
    """The first `most` pages by title that diagnostics read: a limit on a total order, so each run reads the same pages."""
    return pages.where("ns IN (0, 14) AND redirect IS NULL").orderBy("title", "text").limit(most)


def template_delta(pages: DataFrame, kind: str = "encyclopedia") -> DataFrame:
    """title, template, target: template targets that are not among the page's bracket targets."""
    own = pages.where("ns IN (0, 14) AND redirect IS NULL").withColumn("seen", F.array_distinct(bracket_targets(F.col("text"))))
    raw = with_templates(own).select("title", "seen", F.col("t.name").alias("template"), F.explode(template_targets(F.col("t"), kind)).alias("raw"))
    return raw.withColumn("target", link_target(F.col("raw"))).where("target IS NOT NULL AND NOT array_contains(seen, target)").select("title", "template", "target")


def delta_summary(pages: DataFrame, kind: str = "encyclopedia") -> DataFrame:
    """One row: pages, distinct bracket links, template links, those not in brackets, and their share in percent. One pass over the pages."""
    own = pages.where("ns IN (0, 14) AND redirect IS NULL")
    braced = F.when(F.col("text").contains("{{"), F.col("text"))  # pages without braces hand the parser nothing
    each = own.select(F.array_distinct(bracket_targets(F.col("text"))).alias("seen"), templates_udf(braced).alias("ts"))
    raw = F.flatten(F.transform("ts", lambda t: template_targets(t, kind)))
    each = each.select("seen", F.filter(F.transform(raw, link_target), lambda x: x.isNotNull()).alias("found"))
    size = lambda x: F.coalesce(F.sum(F.size(x)), F.lit(0))
    sums = each.agg(F.count("*").alias("pages"), size("seen").alias("wikilinks"), size("found").alias("template_links"), size(F.filter("found", lambda x: ~F.array_contains("seen", x))).alias("delta"))
    return sums.withColumn("pct", F.when(F.col("wikilinks") > 0, F.round(100 * F.col("delta") / F.col("wikilinks"), 3)).otherwise(F.lit(0.0)))


def top_templates(pages: DataFrame, kind: str = "encyclopedia", most: int = 30) -> DataFrame:
    from ..functions.text import template_name

    return template_delta(pages, kind).groupBy(template_name(F.col("template")).alias("template")).count().orderBy(F.desc("count"), "template").limit(most)
