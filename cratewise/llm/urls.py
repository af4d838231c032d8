"""Verdicts on urls: fixed rules, and logistic regression on hashed character n-grams.

A url's host and path are cut out in the JVM. The longest fitting rule decides; where none
fits, n-grams of 3 to 5 bytes of host and of path are hashed and weighed by a model that the
driver trains on a small labelled table. One pass without a shuffle; only the url column is
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.llm.words import mixed, slices

ALLOW, BLOCK = "allow", "block"
BUCKETS = 1 << 15
SIZES = (3, 4, 5)
STEPS = 1500
STRENGTH = 4.0
DECAY = 0.0003

# Fixed values: (host, path, verdict).
RULES = [
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
]

# The labelled table: hosts that are blocked with any path, hosts that are not, paths for both.
BLOCKED_HOSTS = """
free-bets.example.com adult-x.example.com spam-farm.example.com ads-track.example.com
casino-bonus.example.com xxx-videos.example.com buy-pills-now.example.com payday-loans.example.com
best-casino.example.net online-poker.example.net adult-cams.example.net track-ads.example.net
free-slots.example.net spam-links.example.net hot-singles.example.net win-free-prizes.example.net
cheap-pills.example.org click-track.example.org betting-tips.example.org free-torrents.example.org
crack-warez.example.org casino-win.example.org link-farm.example.org pixel-ads.example.org
""".split()
ALLOWED_HOSTS = """
example.com thing.example.com weather.example.com city-council.example.com
wiki.example.com reading.example.com music.example.com travel.example.com
example.net news.then.net docs.example.net school.example.net
therere.example.net recipes.example.net the-times.example.net history.example.net
example.org library.example.org gardening.example.org museum.example.org
onthe.example.org physics-notes.example.org tionand.example.org news.town.org
""".split()
PATHS = "/ /en/1204 /de/77.html /fr/3051/ /es/912 /about /index.html /news/2001/05/item.html".split()
FRONTS = ("", "www.", "m.", "blog.")
LABELLED = [
    (f"http://{FRONTS[i % 4]}{host}{path}", label)
    for label, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS))
    for host in hosts
    for i, path in enumerate(PATHS)
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// to /, ?, # or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end to ?, # or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    offset: float


def _ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram; a text is seen with a start and an end mark."""
    count = len(offsets) - 1
    marked = np.zeros(len(data) + 2 * count, np.uint64)
    shift = np.arange(count).repeat(np.diff(offsets)) * 2 + 1
    marked[np.arange(len(data)) + shift] = data.astype(np.uint64) + np.uint64(2)
    ends = offsets[1:] + 2 * np.arange(1, count + 1)
    marked[ends - 1] = 1
    last = np.repeat(ends, np.diff(offsets) + 2)
    owner = np.repeat(np.arange(count), np.diff(offsets) + 2)
    texts, buckets = [], []
    for size in SIZES:
        n = max(0, len(marked) - size + 1)
        value = np.full(n, np.uint64(size), np.uint64)
        for i in range(size):
            value = mixed(value * np.uint64(263) + marked[i : i + n])
        inside = np.arange(n) + size <= last[:n]
        texts.append(owner[:n][inside])
        buckets.append((value[inside] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(buckets)


def _logits(parts: dict[str, tuple[np.ndarray, np.ndarray]], count: int, model: Model) -> np.ndarray:
    """Each part's n-grams weigh as their sum over the root of their number."""
    total = np.full(count, model.offset)
    for name, (texts, buckets) in parts.items():
        sums = np.bincount(texts, model.weights[name][buckets], minlength=count)
        total += sums / np.sqrt(np.maximum(np.bincount(texts, minlength=count), 1))
    return total


def _packed(values: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [value.encode() for value in values]
    return np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)])


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path as the columns have them."""
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min([rest.find(x) for x in "/?#" if x in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.find(x) for x in "?#" if x in path], default=len(path))
    lowered = rest[:end].translate(str.maketrans(_UPPER, _LOWER))
    return lowered, path[:stop]


def train(labelled: Sequence[tuple[str, int]]) -> Model:
    """Gradient steps on all rows; 1 is to be blocked. No rows block nothing."""
    urls = [split_url(url) for url, _ in labelled]
    labels = np.array([label for _, label in labelled], float)
    parts = {
        name: _ids(*_packed([url[i] for url in urls])) for i, name in enumerate(("host", "path"))
    }
    model = Model({name: np.zeros(BUCKETS) for name in parts}, 0.0 if len(labels) else -STRENGTH)
    for _ in range(STEPS if len(labels) else 0):
        error = 1 / (1 + np.exp(-_logits(parts, len(labels), model))) - labels
        for name, (texts, buckets) in parts.items():
            share = 1 / np.sqrt(np.maximum(np.bincount(texts, minlength=len(labels)), 1))
            gradient = np.bincount(buckets, (error * share)[texts], minlength=BUCKETS)
            model.weights[name] -= STRENGTH * (gradient / len(labels) + DECAY * model.weights[name])
        model.offset -= STRENGTH * error.mean()
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "path"):
                hosts = part.column("host").to_pylist()
                parts = {"host": _ids(*_packed(hosts)), "path": _ids(data, offsets)}
                score = 1 / (1 + np.exp(-_logits(parts, part.num_rows, model)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score, pa.float64())], [*part.schema.names, "score"]
                )

    return run


def fitting_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host and path as one string) that fits, and its verdict; else null.

    A rule fits its host and all subdomains of it if the path starts with the rule's. Of rules
    of one length the first as listed wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(reversed(rules), key=lambda x: len(x[0] + x[1])):
        of_host = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = of_host & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def url_verdicts(
    pages: DataFrame,
    labelled: Sequence[tuple[str, int]] = LABELLED,
    rules: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url).

    ``score`` is the model's chance that the url is to be blocked; it decides where no rule
    fits, from one half on. A null url, or one without ://, has an empty host and path and is
    scored as such. No rows give no rows.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = cut.mapInArrow(
        _score(train(labelled)), f"page_id {kind}, host string, path string, score double"
    )
    rule, verdict = fitting_rule(rules)
    own = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score"
    )
