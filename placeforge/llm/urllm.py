"""Character language-model ratio for URLs.

Longest-match rules judge what they can. Their verdicts label URLs as accepted or rejected, and each
class gets a variable-order Markov model over characters with Witten-Bell smoothing, fitted on every
labelled row of the table. A URL without a rule is judged by the difference of the two log-likelihoods,
divided by its length. The cut is calibrated on a fold of labelled URLs that the models never saw: at most the
given share of accepted ones falls below it, and where the two classes leave room it lies halfway between them.

Counts are exact and grow with the corpus: one row for each string of ORDERS characters that occurs, in a distributed
table. Counts of shorter strings are sums of theirs. A string's probabilities need the strings that share its
two nearest context characters, of which there are at most SYMBOLS ** 3, and the counts of pairs, at most SYMBOLS ** 2; so
every task's memory is bounded whatever the corpus. The table of log ratios is broadcast while it has at most
BROADCAST_GRAMS rows, and joined beyond that with the same results (ratios are added up as whole numbers).

Defined results: a null URL or one without `://` has an empty host and path and no rule; the model reads the whole URL, of
a null or empty one nothing (difference 0). With no accepted or no rejected URL the model says allow. A URL at the
cut is allowed. Characters outside the alphabet count as one, capitals as small letters. Repeated rows get equal
verdicts. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import bounded_batches, durable, map_columns

#: (host, path start, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Share of unseen labelled URLs that the cut may judge wrongly, in percent.
FALSE_PERCENT = 1.0
ORDERS = 5  # contexts of 0 to 4 characters
SYMBOLS = 64
BITS = 6
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-_~%&=?+:@!$'()*,;[]#"
#: The most rows of 12 bytes that are broadcast.
BROADCAST_GRAMS = 2_000_000
#: Strings that a task holds before it sends their counts on.
HELD_GRAMS = 1 << 20
#: Log ratios are added up in these units, and the cut is found among steps of this size.
UNIT, STEP = 1 << 24, 1 / 1024

_CODE = np.full(256, SYMBOLS - 1, dtype=np.int64)
for _i, _c in enumerate(_ALPHABET):
    _CODE[ord(_c)] = _i + 1
    _CODE[ord(_c.upper())] = _i + 1


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://`."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :], re.S)
    host = m[1].translate({c: c + 32 for c in range(65, 91)})
    return host, m[2]


def rule_of(host: str, path: str, rules=RULES) -> tuple[str | None, str | None]:
    """The longest rule that fits, and its verdict."""
    best = max(
        (r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])),
        key=lambda r: len(r[0]) + len(r[1]),
        default=None,
    )
    return (None, None) if best is None else (best[0] + best[1], best[2])


def whole(url: str | None) -> str:
    """What the models read: all after the scheme, the host in small letters; without `://` the whole."""
    if not url or (at := url.find("://")) < 0:
        return url or ""
    host, _ = split_url(url)
    return host + url[at + 3 + len(host) :]


def held_out(url: str) -> bool:
    return zlib.crc32(url.encode("utf-8")) % 5 == 0


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each character of all texts and an end mark: it and the four before it in one number, and its text.

    The character has the lowest bits, the one before it the next; 0 stands for the end and for what is before the start.
    An empty text has none.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lens = np.array([len(x) + 1 if x else 0 for x in raw], dtype=np.int64)
    owner = np.repeat(np.arange(len(raw)), lens)
    if len(owner) == 0:
        return owner, owner
    code = _CODE[np.frombuffer(b"".join(x + b"\0" for x in raw if x), dtype=np.uint8)]
    ends = np.cumsum(lens)[lens > 0]
    code[ends - 1] = 0
    inside = np.arange(len(code)) - np.repeat(np.concatenate([[0], ends[:-1]]), lens[lens > 0])
    packed = code.copy()
    for k in range(1, ORDERS):
        before = np.zeros(len(code), dtype=np.int64)
        before[k:] = code[:-k]
        before[inside < k] = 0
        packed |= before << (BITS * k)
    return packed, owner


def _summed(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of all parts with their summed counts."""
    gram, a, r = (np.concatenate([p[k] for p in parts]) for k in range(3))
    found, at = np.unique(gram, return_inverse=True)
    return found, np.bincount(at, a, len(found)).astype(np.int64), np.bincount(at, r, len(found)).astype(np.int64)


def gather(df: DataFrame, rules=RULES) -> DataFrame:
    """gram, accepted, rejected: every gram of every row, with its counts in the labelled rows outside the calibration fold."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def sent(part: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part[0].astype(np.int32)), pa.array(part[1]), pa.array(part[2])], names=["gram", "accepted", "rejected"])

        for b in batches:
            urls = b.column(0).to_pylist()
            verdicts = [rule_of(*split_url(u), rules)[1] if u and not held_out(u) else None for u in urls]
            gram, owner = grams([whole(u) for u in urls])
            marks = [np.array([v == x for v in verdicts], dtype=np.int64)[owner] for x in ("allow", "block")]
            held.append(_summed([(gram, *marks)]))
            size += len(held[-1][0])
            if size >= HELD_GRAMS:
                held = [_summed(held)]
                size = len(held[0][0])
                if 2 * size >= HELD_GRAMS:
                    yield sent(held[0])
                    held, size = [], 0
        if held:
            yield sent(_summed(held))

    got = df.select("url").mapInArrow(run, "gram int, accepted long, rejected long").groupBy("gram")
    return durable(got.agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "url-grams")


def pair_counts(counts: DataFrame) -> np.ndarray:
    """(2, SYMBOLS, SYMBOLS): how often each symbol follows each other, by class; at most SYMBOLS ** 2 rows reach the driver."""
    pairs = counts.groupBy((F.col("gram").bitwiseAND(SYMBOLS**2 - 1)).alias("pair")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    out = np.zeros((2, SYMBOLS**2))
    for x in pairs.collect():
        out[:, x["pair"]] = x["a"], x["r"]
    return out.reshape(2, SYMBOLS, SYMBOLS)


def _mixed(p: np.ndarray, count, total, kinds) -> np.ndarray:
    """Witten-Bell: the count in a context and the shorter context's p, which weighs as much as the context has kinds."""
    return np.where(total > 0, (count + kinds * p) / np.maximum(total + kinds, 1), p)


def probabilities(gram: np.ndarray, count: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """P(character | context) of each gram by one class's counts. All grams with the same two nearest context characters are here."""
    symbol, before = gram & (SYMBOLS - 1), (gram >> BITS) & (SYMBOLS - 1)
    alone = pairs.sum(0)
    p = _mixed(np.full(len(gram), 1.0 / SYMBOLS), alone[symbol], alone.sum(), (alone > 0).sum())
    p = _mixed(p, pairs[before, symbol], pairs[before].sum(1), (pairs[before] > 0).sum(1))
    for k in range(2, ORDERS):
        keys, at = np.unique(gram & (SYMBOLS ** (k + 1) - 1), return_inverse=True)
        sums = np.bincount(at, count, len(keys))
        _, of = np.unique(keys >> BITS, return_inverse=True)
        p = _mixed(p, sums[at], np.bincount(of, sums)[of][at], np.bincount(of, sums > 0)[of][at])
    return p


def log_ratios(counts: DataFrame, pairs: np.ndarray) -> DataFrame:
    """gram and its log-likelihood difference in UNITs, accepted over rejected, for each row of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def work(rows: np.ndarray) -> pa.RecordBatch:
            ps = [probabilities(rows[0], rows[1 + k], pairs[k]) for k in (0, 1)]
            ratio = np.rint((np.log(ps[0]) - np.log(ps[1])) * UNIT).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(rows[0].astype(np.int32)), pa.array(ratio)], names=["gram", "ratio"])

        for b in batches:
            held.append(np.stack([c.to_numpy().astype(np.int64) for c in b.columns]))
            if sum(x.shape[1] for x in held) >= HELD_GRAMS:
                rows = np.concatenate(held, 1)
                near = (rows[0] >> BITS) & (SYMBOLS**2 - 1)
                cut = int(np.searchsorted(near, near[-1]))  # sorted by it; the last one may go on
                if cut:
                    yield work(rows[:, :cut])
                held = [rows[:, cut:]]
        if held:
            yield work(np.concatenate(held, 1))

    near = F.shiftright("gram", BITS).bitwiseAND(SYMBOLS**2 - 1)
    dealt = counts.withColumn("near", near).repartition("near").sortWithinPartitions("near")
    return dealt.select("gram", "accepted", "rejected").mapInArrow(run, "gram int, ratio long")


_SCORED = "page_id long, url string, host string, path string, rule string, verdict string"


def by_broadcast(df: DataFrame, ratios: DataFrame, rules=RULES) -> DataFrame:
    """Rows with their rule's verdict and log ratio; the table of ratios goes to every task."""
    got = ratios.toArrow()
    gram, ratio = got.column("gram").to_numpy(), got.column("ratio").to_numpy()
    order = np.argsort(gram)
    shared = df.sparkSession.sparkContext.broadcast((gram[order], ratio[order]))

    def make():
        known, value = shared.value

        def run(ids, urls):
            judged = judge(urls, rules)
            found, owner = grams([whole(u) for u in urls])
            n = np.maximum(np.bincount(owner, minlength=len(urls)), 1)
            sums = np.zeros(len(urls), dtype=np.int64)
            if len(found):
                np.add.at(sums, owner, value[np.searchsorted(known, found)])
            return ids, urls, *judged, (sums / UNIT / n).tolist()

        return run

    return map_columns(df, ("page_id", "url"), f"{_SCORED}, log_ratio double", make, 4096)


def judge(urls: list, rules=RULES) -> tuple[list, list, list, list]:
    """Host, path, rule and its verdict of each URL."""
    parts = [split_url(u) for u in urls]
    found = [rule_of(h, p, rules) for h, p in parts]
    return [h for h, _ in parts], [p for _, p in parts], [r for r, _ in found], [v for _, v in found]


def by_join(df: DataFrame, ratios: DataFrame, rules=RULES) -> DataFrame:
    """The same by joins: each distinct URL's grams meet their ratios, and the sums go back to the rows."""
    rows = map_columns(df, ("page_id", "url"), _SCORED, lambda: lambda ids, urls: (ids, urls, *judge(urls, rules)), 4096)
    urls = df.select("url").filter("url is not null").distinct().select(F.monotonically_increasing_id().alias("u"), "url")
    urls = durable(urls, "urls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for at in range(0, b.num_rows, 4096):
                gram, owner = grams([whole(u) for u in b.column(1).slice(at, 4096).to_pylist()])
                # A gram that a URL repeats is one row with its number.
                both, n = np.unique(np.stack([owner, gram]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at + both[0]]), pa.array(both[1].astype(np.int32)), pa.array(n)], names=["u", "gram", "n"])

    found = urls.mapInArrow(run, "u long, gram int, n long").join(ratios, "gram")
    sums = found.groupBy("u").agg((F.sum(F.col("ratio") * F.col("n")) / F.lit(float(UNIT)) / F.sum("n")).alias("log_ratio"))
    by_url = urls.join(sums, "u").select(F.col("url").alias("__url"), "log_ratio")
    joined = rows.join(by_url, F.col("url") == F.col("__url"), "left").drop("__url")
    return joined.withColumn("log_ratio", F.coalesce("log_ratio", F.lit(0.0)))


def calibrate(scored: DataFrame, false_percent: float = FALSE_PERCENT) -> float:
    """The cut, from counts of the held-out labelled rows by steps of log ratio (a few ten thousand at most)."""
    fold = scored.filter(F.col("verdict").isNotNull() & (F.crc32(F.col("url").cast("binary")) % 5 == 0))
    steps = fold.groupBy("verdict", F.floor(F.col("log_ratio") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    sides = {v: sorted((r["step"], r["n"]) for r in steps if r["verdict"] == v) for v in ("allow", "block")}
    bounds = {}
    for verdict, found in sides.items():
        # From the wrong end inward: the first step whose rows would be one too many.
        inward = found if verdict == "allow" else found[::-1]
        left = sum(n for _, n in found) * false_percent / 100
        for step, n in inward:
            left -= n
            if left < 0:
                bounds[verdict] = step if verdict == "allow" else step + 1
                break
    low, high = bounds.get("block"), bounds.get("allow")
    if high is None:
        return 0.0 if low is None else low * STEP
    return high * STEP if low is None or low >= high else (low + high) / 2 * STEP


def url_filter(df: DataFrame, rules=RULES, false_percent: float = FALSE_PERCENT, most: int = BROADCAST_GRAMS) -> DataFrame:
    """page_id, host, path, rule, verdict and log_ratio for each row of df (page_id, url)."""
    counts = gather(df, rules)
    size, accepted, rejected = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("accepted"), F.lit(0)), F.coalesce(F.sum("rejected"), F.lit(0))).first()
    judged = bool(accepted and rejected)
    ratios = durable(log_ratios(counts, pair_counts(counts)), "url-ratios") if judged else counts.select("gram", F.lit(0).cast("long").alias("ratio"))
    scored = durable((by_broadcast if size <= most else by_join)(df, ratios, rules), "url-scores")
    cut = calibrate(scored, false_percent) if judged else -1.0
    by_model = F.when(F.col("log_ratio") >= F.lit(cut), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_model).alias("verdict"), "log_ratio")
