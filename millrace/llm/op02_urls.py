"""URL filter: rules first, then logistic regression on hashed character n-grams.

The model is fitted on the driver from a small labelled table of urls (a parameter; TRAINING by
default), never from the rows it judges. Each row is scored by itself: no shuffle.

Cases: a null url, or one without "://", has empty host and path and gets the model's verdict
on the empty string; very long urls are read whole; repeated rows get equal verdicts; an empty
table gives no rows. Only page_id and url are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, code_points, mix, pick

# Fixed values of the contract: rule (host and path), verdict.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

# The labelled table: host and path, 1 for unwanted.
TRAINING: tuple[tuple[str, int], ...] = (
    ("cheap-pills.example.com/en/450", 1), ("www.cheap-pills.example.net/fr/176/", 1),
    ("pills-online.test/buy", 1), ("best-pharmacy-pills.test/order/cheap", 1),
    ("casino-win.example.org/en/14", 1), ("www.casino-win.example.com/de/9", 1),
    ("online-casino.test/slots/jackpot", 1), ("royal-casino-bonus.test/play", 1),
    ("free-bets.example.com/en/27", 1), ("m.free-bets.example.com/de/963", 1),
    ("sports-bets.test/free/odds", 1), ("bets-free-spins.test/win", 1),
    ("ads-track.example.org/en/584", 1), ("www.ads-track.example.net/es/12", 1),
    ("ads.tracker.test/click", 1), ("adserver-track.test/pixel/ads", 1),
    ("spam-farm.example.org/en/728", 1), ("blog.spam-farm.example.com/en/5", 1),
    ("link-spam.test/farm/page", 1), ("seo-spam-farm.test/links", 1),
    ("xxx-cams.test/live", 1), ("hot-porn-videos.test/watch", 1), ("adult-sex-cams.test/xxx", 1),
    ("win-prize-now.test/free/gift", 1), ("cheap-loans-fast.test/apply", 1),
    ("replica-watches-cheap.test/buy", 1), ("viagra-cheap.test/pills", 1),
    ("torrent-crack-free.test/download", 1), ("clickbait-ads.test/track", 1),
    ("lottery-win-jackpot.test/claim", 1),
    ("ththre.example.com/fr/825", 0), ("m.ththth.example.net/en/25", 0),
    ("thther.example.org/en/685", 0), ("blog.tiontion.example.com/en/853/", 0),
    ("www.therti.example.org/en/334/", 0), ("ththble.example.net/es/797", 0),
    ("library.test/catalogue/history", 0), ("news.test/world/politics/article", 0),
    ("www.university.test/courses/biology", 0), ("museum.test/collection/paintings", 0),
    ("recipes.test/soup/lentil", 0), ("docs.test/guide/install", 0),
    ("weather.test/forecast/week", 0), ("blog.garden.test/roses/pruning", 0),
    ("city.test/council/minutes", 0), ("wiki.test/wiki/astronomy", 0),
    ("journal.test/issue/12/paper", 0), ("school.test/lessons/grammar", 0),
    ("hospital.test/departments/cardiology", 0), ("trains.test/timetable/north", 0),
    ("radio.test/programmes/evening", 0), ("books.test/review/novel", 0),
    ("blog.thernd.example.net/de/612", 0), ("thering.example.com/en/328/", 0),
    ("therat.example.net/en/231", 0), ("www.theres.example.com/de/519", 0),
    ("blog.ththan.example.net/en/960", 0), ("ththin.example.com/en/671", 0),
    ("therha.example.com/en/676", 0), ("m.tionsh.example.org/es/533/", 0),
)

GRAMS = (3, 4, 5)
DIMENSION = 1 << 16
EPOCHS, RATE, L2 = 300, 2.0, 1e-4


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        of, slash, rest = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, and of which text each is. A text is padded by ^ and $."""
    points, starts = code_points([f"^{t}$" for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    hashed, owners = [], []
    for n in GRAMS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = mix(h + points[k : len(points) - n + 1 + k].astype(np.uint64))
        within = owner[: len(h)] == owner[n - 1 :]
        hashed.append((h[within] % np.uint64(DIMENSION)).astype(np.int64))
        owners.append(owner[: len(h)][within])
    if not hashed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashed), np.concatenate(owners)


def logits(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """weights[0] is the bias; a text's n-gram weights are averaged."""
    f, o = features(texts)
    n = np.maximum(1, np.bincount(o, minlength=len(texts)))
    return weights[0] + np.bincount(o, weights[1 + f], minlength=len(texts)) / np.sqrt(n)


def fit(labelled: Sequence[tuple[str, int]] = TRAINING) -> np.ndarray:
    """Weights by gradient descent over the whole labelled table, which is small by contract."""
    texts, y = [t for t, _ in labelled], np.array([y for _, y in labelled], dtype=float)
    f, o = features(texts)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(o, minlength=len(texts))))
    w = np.zeros(1 + DIMENSION)
    for _ in range(EPOCHS):
        error = 1 / (1 + np.exp(-logits(texts, w))) - y
        gradient = np.bincount(f, (error * scale)[o], minlength=DIMENSION) / len(texts)
        w[1:] -= RATE * (gradient + L2 * w[1:])
        w[0] -= RATE * error.mean() / 10
    return w


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: Sequence[tuple[str, int]] = TRAINING,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of being unwanted."""
    weights = fit(labelled)
    shared = pages.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    parts = pick(pages, "page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(float)
        joined = (
            pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([h + p for h, p in zip(b["host"].to_pylist(), b["path"].to_pylist())], pa.string())],
                names=[*b.schema.names, "url"],
            )
            for b in batches
        )
        for batch, texts in chunks(joined, "url", 2_000_000):
            p = 1 / (1 + np.exp(-logits(texts, w)))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["host"], batch["path"], pa.array(p)],
                names=["page_id", "host", "path", "score"],
            )

    scored = parts.mapInArrow(score, "page_id bigint, host string, path string, score double")
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    for name, what in rules:
        verdict = F.when(F.col("rule") == name, what).otherwise(verdict)
    return scored.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "score"
    )
