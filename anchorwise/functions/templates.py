"""Template rules, and the expansion of templates in rendered pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where article templates point to, and the mark of articles in text.
ARTICLE_URL = "http://en.wikipedia.org/wiki/"
ARTICLE_MARK = "_wikiarticle_"
_EDGE = re.compile(r"\{\{|\}\}")
#: What makes a rule more than a name.
_SPECIAL = re.compile(r"[\\.^$*+?{}\[\]|()]")


def parse_rules(lines: list[str]) -> list[tuple[str, str]]:
    """(pattern, action) of each line `pattern => action [# comment]`; blank lines and those that begin with # are skipped."""
    rules = []
    for line in map(str.strip, lines):
        if not line or line.startswith("#"):
            continue
        pieces = line.split(" => ")
        if len(pieces) != 2:
            raise ValueError(f"not a rule: {line!r}")
        rules.append((pieces[0], pieces[1].partition("#")[0].strip()))
    return rules


def default_rules() -> list[tuple[str, str]]:
    return parse_rules((Path(__file__).parent / "template_rules.txt").read_text().splitlines())


class Templates:
    """What the content of a template becomes."""

    def __init__(self, rules: list[tuple[str, str]] | None = None) -> None:
        self.rules = [(re.compile(p), a) for p, a in (default_rules() if rules is None else rules)]
        self.known: dict[str, str | None] = {}

    @staticmethod
    def name(content: str) -> str:
        return content.partition("|")[0].partition(":")[0].strip().lower()

    def action(self, name: str) -> str | None:
        """Of the first rule that the whole name matches, with aliases followed; a circle of aliases has none."""
        if name not in self.known:
            seen, at, found = set(), name, None
            while at not in seen:
                seen.add(at)
                found = next((a for p, a in self.rules if p.fullmatch(at)), None)
                if found is None or not found.startswith("alias:"):
                    break
                at, found = found.removeprefix("alias:"), None
            self.known[name] = found
        return self.known[name]

    @staticmethod
    def anonymous(content: str) -> list[str]:
        """Arguments without a name."""
        pieces = content.split("|")
        while pieces and not pieces[-1]:
            pieces.pop()
        return [x for x in pieces[1:] if "=" not in x]

    def expand(self, content: str, to: str = "html") -> str | None:
        """As `html` or `text`; None for a template without a rule."""
        action = self.action(self.name(content))
        if action is None:
            return None
        if action.startswith("constant:"):
            return action.removeprefix("constant:")
        if action == "text":
            return "".join(f" {x}" for x in self.anonymous(content)) + ", "
        if action == "articles":
            refs = [(x.replace(" ", "_"), x) for x in self.anonymous(content)]
            if to == "text":
                return "".join(f" {ARTICLE_MARK}{ref}" for ref, _ in refs) + " "
            return "".join(f' <a href="{ARTICLE_URL}{ref}">{x}</a> ' for ref, x in refs)
        return ""  # ignored, unknown by rule, or an action that doesn't exist

    def page(self, html: str | None, unknown: Counter | None = None) -> str:
        """Expands the outermost templates. A stray end stays as it is, and so does the text from an open template on."""
        html = html or ""
        out, done, depth, start = [], 0, 0, 0
        for m in _EDGE.finditer(html):
            if m[0] == "{{":
                depth += 1
                if depth == 1:
                    start = m.start()
            elif depth:
                depth -= 1
                if not depth:
                    content = html[start + 2 : m.start()]
                    found = self.expand(content)
                    if found is None and unknown is not None:
                        unknown[self.name(content)] += 1
                    out += [html[done:start], found or ""]
                    done = m.end()
        return "".join([*out, html[done:]])


def expand_templates(html: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """Nesting is beyond regular expressions, so this is an Arrow function; texts without a template come back as they are."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        templates = Templates(rules)
        for texts in batches:
            yield texts.map(lambda t: templates.page(t) if t and "{{" in t else t, na_action=None)

    return run(html)


def unknown_templates(df: DataFrame, column: str, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """Templates without a rule, with counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates, seen = Templates(rules), Counter()
        for batch in batches:
            for text in batch[column]:
                templates.page(text, seen)
        yield pd.DataFrame({"template": list(seen), "n": list(seen.values())}).astype({"template": str, "n": "int64"})

    return df.filter(F.col(column).contains("{{")).select(column).mapInPandas(run, "template string, n long").groupBy("template").agg(F.sum("n").alias("n"))


def template_name(content: Column) -> Column:
    """The native form of Templates.name()."""
    return F.lower(F.trim(F.split_part(F.split_part(content, F.lit("|"), F.lit(1)), F.lit(":"), F.lit(1))))


def anonymous_parameters(content: Column) -> Column:
    pieces = F.split(F.regexp_replace(content, r"\|+$", ""), r"\|")
    return F.filter(F.slice(pieces, F.lit(2), F.size(pieces)), lambda x: ~x.contains("="))


def expand_template(content: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The native form of Templates.expand() for a column of template contents, with aliases resolved beforehand. The name is made once; rules that are plain names are looked up, patterns tried in
    turn, and of both the first rule counts."""
    rules, templates = default_rules() if rules is None else rules, Templates(rules)
    if not rules:
        return F.lit(None).cast("string")
    args = anonymous_parameters(content)
    text = F.concat(F.array_join(F.transform(args, lambda x: F.concat(F.lit(" "), x)), ""), F.lit(", "))
    link = lambda x: F.concat(F.lit(f' <a href="{ARTICLE_URL}'), F.translate(x, " ", "_"), F.lit('">'), x, F.lit("</a> "))
    articles = F.array_join(F.transform(args, link), "")
    actions = [templates.action(a.removeprefix("alias:")) if a.startswith("alias:") else a for _, a in rules]
    values = F.array(*(F.lit(None if a is None else a.removeprefix("constant:") if a.startswith("constant:") else "").cast("string") for a in actions))
    names: dict[str, int] = {}
    patterns = []
    for k, (pattern, _) in enumerate(rules, 1):
        if _SPECIAL.search(pattern):
            patterns.append((k, pattern))
        else:
            names.setdefault(pattern, k)

    def rule(name: Column) -> Column:
        """The place of the first rule for a name, from 1; null without one."""
        tried = None
        for k, pattern in patterns:
            tried = (F if tried is None else tried).when(name.rlike(f"^(?:{pattern})$"), F.lit(k))
        # A pattern's end also stands before a last line end, so names by themselves are looked up without it.
        looked = F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.regexp_replace(name, r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])\z", "")) if names else None
        return looked if tried is None else tried if looked is None else F.least(looked, tried)

    def result(k: Column) -> Column:
        is_ = lambda kind: k.isin([i for i, a in enumerate(actions, 1) if a == kind])
        return F.when(k.isNull(), None).when(is_("text"), text).when(is_("articles"), articles).otherwise(F.element_at(values, k))

    once = lambda value, body: F.transform(F.array(value), body)[0]
    return once(once(template_name(content), rule), result)


def markup_to_html(text: Column) -> Column:
    """Markup in arguments of templates is left as it is."""
    return text


def markup_to_text(text: Column) -> Column:
    """Markup in arguments of templates is left as it is."""
    return text
