"""URL filter (operator 3): rules by host and path, and else logistic regression on hashed character n-grams of host and path.

The model is trained on the driver from a small labelled table (LABELLED unless another is given), which is bounded by nature, with
full-batch gradient steps that always give the same weights. Scoring is one pass over the urls; the weights travel with the task. The table is made up of
common words; none of its hosts is in the pages that the query judges, so what the model says of them is not remembered.

Null urls and those without `://` have an empty host and path and fit no rule. Without an n-gram the model's score is the share of unwanted rows in its table, under
a half, so they are allowed. Repeated rows are each judged; a url of any length is one row of n-grams; columns but page_id and url are not read, whatever
their names; an empty table gives no rows."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

BITS, SIZES = 16, (3, 4, 5)
# Words of unwanted and of other hosts, a family of unwanted ones to a line. None is a word of a host of `pages`.
UNWANTED_FAMILIES = [line.split() for line in """
adserver adservice adverts adclick
adults adulttoys adulttube
affiliate affiliates
banner banners
betting bettor betshop sportsbet
bingo bingohall
cams livecams camgirls
casinos kasino casinoclub
cheaper cheapest cheapmeds
clickbait clickbaits
cracked cracks crackz
crypto cryptos cryptocoins
escort escorts
followers buyfollowers
gambling gamblers gamble
jackpot jackpots
keygen keygens
loans payloans quickloan
lottery lotteries lotto
malware malwares
meds medsale
payday paydays
pharmacy pharmacies
pill pillshop dietpill
poker pokerroom
popups popup
porn porno porntube
replica replicas
roulette roulettes
seo seolinks
sexy sexcam
singles hotsingles
slots slotmachine
spammer spammy spambot
spyware spywares
tracker tracking trackers
viagra viagras
warez warezz
winner winners
xxx xxxtube
""".strip().split("\n")]  # fmt: skip
UNWANTED = [w for family in UNWANTED_FAMILIES for w in family]
WANTED = """
academy agriculture airport animals archive art-museum astronomy athletics atlas authors bakery ballet biology birdwatch bookshop botany bridges brothers-barn bus-times castle ceramics chemistry choir cinema
city-council climate coastline college community concerts cooking courthouse cycling dance dentist dictionary drawing earthquake education electronics elections engineering environment european-history family-tree farming
festival finance firefighters fishing flowers folk-songs football forestry fountain gallery gardening geography geology government guitar handicraft harbour health heritage hiking history hospital housing
insects institute islands journal kitchen knitting landscape language lecture letters library lighthouse literature mathematics medicine meeting meteorology monument mother-tongue mountains music national-park nature
newspaper northern-lights nursery observatory ocean opera orchards orchestra painting parliament pharmacology philosophy photographs physics pianos planets poetry pottery printing psychology publishing radio railway
recipes research restaurant river-path road-atlas sailing school science sculpture secondary-school sewing sheet-music singing skating society southern-cross stamps station statistics students surveyor swimming
teachers technology telescope tennis theatre theology tourism town-hall traditions trains translation travel university vegetables village volunteers walking weather weaving wildlife winery workshop zoology
""".split()  # fmt: skip


def _urls(words: list[str], copies: int, seed: int) -> list[str]:
    """Hosts with paths, each word in so many of them, with the same choice of affixes, sub-domains, top domains and paths for both kinds, made at random."""
    pick = random.Random(seed).choice
    form, sub, top, path = ("{}", "my-{}", "{}-online", "{}-page"), ("", "www.", "m.", "blog.", "news."), ("com", "net", "org"), ("en/{}", "de/{}.html", "fr/{}/", "es/{}", "")
    return [f"{pick(sub)}{pick(form).format(w)}.example.{pick(top)}/{pick(path).format(pick(range(10_000)))}" for w in words for _ in range(copies)]


LABELLED = [(x, 1) for x in _urls(UNWANTED, 12, 1)] + [(x, 0) for x in _urls(WANTED, 8, 2)]
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case, and path."""
    m = _URL.search(url or "")
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


class Rules:
    """(host, path, verdict) rules. One fits its host and all subdomains where the path starts with its own; the longest wins."""

    def __init__(self, rules: list[tuple[str, str]]) -> None:
        """rules: (verdict, host and path), such as ("block", "example.com/de/")."""
        self.of: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.of.setdefault(host, []).append((slash + path, rule, verdict))

    def best(self, host: str, path: str) -> tuple[str, str] | None:
        labels, found = host.split("."), None
        for k in range(len(labels)):
            for start, rule, verdict in self.of.get(".".join(labels[k:]), ()):
                if path.startswith(start) and (found is None or len(rule) > len(found[0])):
                    found = (rule, verdict)
        return found


def grams(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each name (with marks at both ends), and offsets."""
    raw = [f"^{x}$".encode() for x in names]
    size = np.array([len(x) for x in raw], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    x = np.frombuffer(b"".join(raw), np.uint8)
    out, own = [], []
    for n in SIZES:
        count = np.maximum(size - n + 1, 0)
        place = common.gathered(at[:-1], count)
        h = np.full(len(place), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + x[place + k]
        out.append((common.mixed(h) >> np.uint64(64 - BITS)).astype(np.int64))
        own.append(np.repeat(np.arange(len(names)), count))
    own, out = np.concatenate(own), np.concatenate(out)
    order = np.argsort(own, kind="stable")
    return out[order], np.searchsorted(own[order], np.arange(len(names) + 1))


class Model:
    """Logistic regression; a name's features are its n-grams, scaled to length 1."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    @classmethod
    def train(cls, labelled: list[tuple[str, int]] | None = None, *, rounds: int = 400, rate: float = 20.0, ridge: float = 1e-4) -> Model:
        labelled = labelled or LABELLED
        g, at = grams([x for x, _ in labelled])
        size = np.diff(at)
        own, y = np.repeat(np.arange(len(labelled)), size), np.array([t for _, t in labelled], float)
        scale = 1 / np.sqrt(np.maximum(size, 1))
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        w, b = np.zeros(1 << BITS), float(np.log(share / (1 - share)))  # fixed: the score without n-grams
        for _ in range(rounds):
            z = np.bincount(own, w[g], len(labelled)) * scale + b
            miss = 1 / (1 + np.exp(-z)) - y
            w -= rate * (np.bincount(g, (miss * scale)[own], len(w)) / len(labelled) + ridge * w)
        return cls(w.astype(np.float32), float(b))

    def scores(self, names: list[str]) -> np.ndarray:
        g, at = grams(names)
        size = np.diff(at)
        z = np.bincount(np.repeat(np.arange(len(names)), size), self.weights[g].astype(float), len(names)) / np.sqrt(np.maximum(size, 1)) + self.bias
        return 1 / (1 + np.exp(-z))


def judge(pages: DataFrame, rules: list[tuple[str, str]], model: Model | None = None, *, limit: float = 0.5) -> DataFrame:
    """Per row of pages (page_id, url): page_id, host, path, rule, verdict, score (the model's, that the url is unwanted)."""
    model = model or Model.train()
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Rules(rules)
        for batch in batches:
            both = [split(u) for u in common.column(batch, "url").to_pylist()]
            score = model.scores([h + p for h, p in both]) if both else np.zeros(0)
            fits = [known.best(h, p) for h, p in both]
            verdict = [f[1] if f else "block" if s >= limit else "allow" for f, s in zip(fits, score, strict=True)]
            yield pa.RecordBatch.from_arrays([common.column(batch, "page_id"), *(pa.array(c, pa.string()) for c in ([h for h, _ in both], [p for _, p in both], [f[0] if f else None for f in fits], verdict)), pa.array(score)], ["page_id", "host", "path", "rule", "verdict", "score"])

    return pages.select("page_id", "url").transform(common.mapped, run, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
