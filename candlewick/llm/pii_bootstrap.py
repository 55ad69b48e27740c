"""Personal data: exact base kinds, and identifiers found by bootstrapped contexts.

The base kinds (email, ip, card, phone) are found in one Arrow pass over whole texts.  They seed
a bootstrap in the manner of pattern-based extraction:

* a *pattern* is the pair of lexical units (words or single signs) right before an instance;
* an *instance* is a base match, or an identifier-like string (6 signs, 3 digits or more);
* *seeds* are the base matches and the strings that have the shape of a secret (key numbers with a known
  prefix, long runs of hexadecimal digits), which count as identifiers by themselves;
* Spark scores the bipartite graph in rounds: a pattern's confidence is the score of what fills its
  slot over all its occurrences in the corpus (ordinary words count as misses), an instance's
  score is the noisy-or of its confident patterns; seeds stay at 1.  Scores only rise, and the
  rounds end when none does any more;
* an instance that reaches MIN_SCORE is an identifier (kind ``id``) wherever it occurs.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import staged, staged_with

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE = 3, 0.6, 0.6
#: Scores that rise by no more than this have stopped; rounds after which it is an error if they have not
#: (a chain of contexts takes a round per hop).
STILL, MAX_ROUNDS = 1e-9, 1000
#: Instances longer than this are known by their hash.
NAME_SIGNS = 64
#: Patterns counted in one pass over the corpus (collected and broadcast together).
BLOCK_PATTERNS = 200_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
TOKEN = re.compile(r"[A-Za-z0-9@._:/+#-]+")
TOKEN_END = re.compile(r"[A-Za-z0-9@._:/+#-]*")
UNIT = re.compile(r"[^\W\d_]+|[\d_]+|[^\w\s]")
#: Shapes of secrets (fixed values of public formats): access key numbers, access tokens, hexadecimal digests.
KEY_PREFIXES = ("AKIA", "ASIA")
KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
SECRET = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{16,}|[0-9A-F]{16,}")
LEFT_SIGNS = 80

SCAN = ("doc_id bigint, key bigint, n array<bigint>, base array<string>, seeds array<struct<instance:string,pattern:string>>, "
        "others array<struct<start:int,stop:int,instance:string,pattern:string,secret:boolean>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @, dotted domain: each @ takes the run of local signs before
    it, back to the previous match."""
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = t.find("@", max(at + 1, end))
    return out


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in order; failing matches are dropped, not retried."""
    out = [(0, a, b) for a, b in emails(t)]
    if DIGITS.search(t):
        out += [(1, *m.span()) for m in IP.finditer(t)
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(t):
            if m.end() - m.start() >= 13:
                digits = re.sub("[^0-9]", "", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        if "+" in t:
            out += [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


def pattern_before(t: str, start: int) -> str:
    """The two lexical units before ``start``, lower case; fewer at a text's beginning."""
    return " ".join(u.lower() for u in UNIT.findall(t[max(0, start - LEFT_SIGNS):start])[-2:])


def identifier_like(t: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Strings of letters, digits and joining signs with 3 digits or more, 6 signs or longer, cut at
    spans that are taken already."""
    end, taken = 0, sorted(taken)
    busy = 0
    for m in DIGITS.finditer(t):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and TOKEN.match(t[start - 1]):
            start -= 1
        end = TOKEN_END.match(t, m.end()).end()
        while busy < len(taken) and taken[busy][1] <= start:
            busy += 1
        if busy < len(taken) and taken[busy][0] < end:
            end = max(end, taken[busy][1])
            continue
        a, b = start, end
        while a < b and not t[a].isalnum():
            a += 1
        while b > a and not t[b - 1].isalnum():
            b -= 1
        if 6 <= b - a and sum(c in "0123456789" for c in t[a:b]) >= 3:
            yield a, b


def name_of(instance: str) -> str:
    """The instance itself, or, of a long one, a name of bounded length that no short one has."""
    if len(instance) <= NAME_SIGNS:
        return instance
    return "sha256:" + hashlib.sha256(instance.encode("utf-8", "surrogatepass")).hexdigest()


def is_secret(instance: str) -> bool:
    """The string has the shape of a secret; of hexadecimal digits, both letters and figures must be there."""
    return (SECRET.fullmatch(instance) is not None
            and sum(c.isdigit() for c in instance) < len(instance) - 2)


def scan_text(t: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans, and the places of identifier-like strings (key numbers need no figures)."""
    base = base_spans(t)
    taken = [(a, b) for _, a, b in base]
    like = list(identifier_like(t, taken))
    if any(x in t for x in KEY_PREFIXES):
        taken = sorted(taken + like)
        starts = [a for a, _ in taken]
        for m in KEY.finditer(t):
            i = bisect_right(starts, m.start())
            if (not i or taken[i - 1][1] <= m.start()) and (i == len(taken) or m.end() <= taken[i][0]):
                like.append(m.span())
        like.sort()
    return base, like


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()),
             pa.list_(pa.struct([("instance", pa.string()), ("pattern", pa.string())])),
             pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()),
                                 ("instance", pa.string()), ("pattern", pa.string()), ("secret", pa.bool_())]))]
    for b in batches:
        n, base, seeds, others = [], [], [], []
        for t in b.column(2).to_pylist():
            found, like = scan_text(t or "")
            n.append([sum(k == i for k, _, _ in found) for i in range(len(KINDS))])
            base.append([f"{KINDS[k]}:{x}:{y}" for k, x, y in found])
            seeds.append([{"instance": t[x:y], "pattern": pattern_before(t, x)} for _, x, y in found])
            others.append([{"start": x, "stop": y, "instance": name_of(t[x:y]), "pattern": pattern_before(t, x),
                            "secret": is_secret(t[x:y])} for x, y in like])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((b.column(0).to_pylist(), b.column(1).to_pylist(), n, base, seeds, others),
                                            types)],
            names=["doc_id", "key", "n", "base", "seeds", "others"])


def _key() -> Column:
    """Rows of equal key have equal doc_id and text, so equal spans."""
    return F.xxhash64("doc_id", "text")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base spans, their contexts, and identifier-like strings."""
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _key().alias("key"),
                        F.col("text").cast("string"))
            .mapInArrow(_scan_batches, SCAN))


def _total_batches(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Occurrences of each pattern of the block in the texts."""
    units, keys, base = sent.value
    total, get = np.zeros(len(keys), np.int64), units.get
    for b in batches:
        ids: list[int] = []
        for t in b.column(0).to_pylist():
            if t:
                ids += [get(u, 0) for u in UNIT.findall(t.lower())]
                ids.append(0)
        x = np.array(ids, np.int64)
        pair = np.where((x[:-1] > 0) & (x[1:] > 0), x[:-1] * base + x[1:], -1)
        pair = pair[pair >= 0]
        if len(pair):
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            total += np.bincount(at[keys[at] == pair], minlength=len(keys))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(total[some])], names=["key", "total"])


def pattern_totals(docs: DataFrame, patterns: DataFrame, block: int = BLOCK_PATTERNS) -> DataFrame:
    """``(pattern, total)``: occurrences in all texts.  Patterns are counted in blocks of at most
    about ``block``, one pass of the corpus each."""
    spark = docs.sparkSession
    patterns = staged(patterns.select("pattern").distinct(), "pii-patterns")
    blocks = max(1, -(-patterns.count() // block))
    out = spark.createDataFrame([], "pattern string, total bigint")
    for i in range(blocks):
        own = [r.pattern for r in patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == i).collect()]
        pairs = sorted(p for p in (tuple(x.split(" ")) for x in own) if len(p) == 2)
        if not pairs:
            continue
        units = {u: n for n, u in enumerate(sorted({u for p in pairs for u in p}), 1)}
        base = len(units) + 1
        keys = np.array([units[a] * base + units[b] for a, b in pairs], np.int64)
        sent = spark.sparkContext.broadcast((units, keys, base))
        sums = (docs.select(F.col("text").cast("string"))
                .mapInArrow(lambda batches, sent=sent: _total_batches(batches, sent), "key bigint, total bigint")
                .groupBy("key").agg(F.sum("total").alias("total")))
        names = spark.createDataFrame([(int(k), " ".join(p)) for k, p in zip(keys, pairs)],
                                      "key bigint, pattern string")
        out = out.unionByName(sums.join(names, "key").select("pattern", "total"))
    return staged(out, "pii-totals")


def discovered(docs: DataFrame, scanned: DataFrame, min_support: int = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE,
               max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``(instance, score)``: identifier-like strings, no seeds, that patterns of the seeds vouch for.  Raises
    if scores still rise after ``max_rounds``."""
    spark = docs.sparkSession
    slot = (scanned.select(F.explode("seeds").alias("e")).select("e.pattern", "e.instance", F.lit(True).alias("seed"))
            .unionByName(scanned.select(F.explode("others").alias("e"))
                         .select("e.pattern", "e.instance", F.col("e.secret").alias("seed"))))
    slot = slot.filter(F.col("pattern").contains(" "))  # the beginning of a text is no context
    edges = slot.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("width"), F.max(~F.col("seed")).alias("open"),
                                        F.sum(F.col("seed").cast("int")).alias("seeds"))
    wide, seen = staged_with(wide.filter(F.col("width") >= min_support), "pii-wide",
                             start=F.sum(F.when(F.col("seeds") >= min_support, 1).otherwise(0)),
                             open=F.sum(F.col("open").cast("int")))
    if not (seen.get("start") and seen.get("open")):
        return spark.createDataFrame([], "instance string, score double")
    total = pattern_totals(docs, wide)
    edges = staged(edges.join(wide.select("pattern"), "pattern")
                   .join(total, "pattern", "left"), "pii-edges")
    own = F.max("seed").cast("double")
    score = edges.groupBy("instance").agg(own.alias("own"), own.alias("score"))
    for _ in range(max_rounds):
        scored = edges.join(score.select("instance", "score"), "instance")
        trust = (scored.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / F.greatest(F.max("total"), F.sum("n"))).alias("confidence"),
            F.sum((F.col("score") >= min_score).cast("int")).alias("support"))
            .filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)))
        heard = (edges.join(trust, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("heard")))
        new = (score.withColumnRenamed("score", "was").join(heard, "instance", "left")
               .select("instance", "own", "was", F.greatest("own", F.coalesce("heard", F.lit(0.0))).alias("score")))
        score, seen = staged_with(new, "pii-round", rise=F.max(F.col("score") - F.col("was")))
        if (seen.get("rise") or 0.0) <= STILL:
            break
        score = score.select("instance", "own", "score")
    else:
        raise RuntimeError(f"scores still rise after {max_rounds} rounds")
    return score.filter((F.col("own") < 1) & (F.col("score") >= min_score)).select("instance", "score")


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: counts and spans of the base kinds, and all spans.

    Columns: doc_id, n (one count per base kind), base and spans (arrays of ``kind:start:end``, code
    points, end exclusive, by kind as listed, then start; ``id`` for secrets and discovered identifiers).  Defined cases: a null text is empty; repeated rows
    are answered each; a null doc_id stays null; an empty table gives no rows; other columns
    are ignored; a text of any length is scanned whole, in linear time.
    """
    rows = staged(scan(docs), "pii-scan")
    found = discovered(docs, rows, **options)
    like = rows.select("key", F.explode("others").alias("e")).select("key", "e.*")
    more = (like.filter("secret").select("key", "start", "stop")
            .unionByName(like.filter("NOT secret").join(found.select("instance"), "instance").select("key", "start", "stop"))
            .groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("ids")))
    text = F.transform(F.coalesce("ids", F.expr("CAST(array() AS array<struct<start:int,stop:int>>)")),
                       lambda e: F.concat(F.lit(f"{FOUND}:"), e["start"], F.lit(":"), e["stop"]))
    return rows.join(more, "key", "left").select("doc_id", "n", "base", F.concat("base", text).alias("spans"))


def redacted(t: str, spans: Iterable[tuple[str, int, int]]) -> str:
    """``t`` with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [t[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, t[end:]])


def _redact(t: str | None, known: set[str]) -> str | None:
    if t is None:
        return None
    base, like = scan_text(t)
    spans = [(KINDS[k], a, b) for k, a, b in base]
    spans += [(FOUND, a, b) for a, b in like if is_secret(t[a:b]) or name_of(t[a:b]) in known]
    return redacted(t, spans) if spans else t


def _redact_batches(batches: Iterator[pa.RecordBatch], known: str | None) -> Iterator[pa.RecordBatch]:
    """Redacted texts.  ``known``: the column of identifiers of a row, which is dropped; None: none."""
    for b in batches:
        at = b.schema.get_field_index("text")
        ids = b.column(known).to_pylist() if known else [()] * b.num_rows
        own = [_redact(t, set(k)) for t, k in zip(b.column(at).to_pylist(), ids)]
        b = b.set_column(at, b.schema.field(at), pa.array(own, b.schema.field(at).type))
        yield b.drop_columns([known]) if known else b


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by ``[KIND]``, n_chars (if there) renewed.

    Same columns and rows; null texts stay null.  Texts are shuffled only where an identifier was
    found beyond the base kinds.
    """
    rows = staged(scan(docs), "pii-scan")
    found = staged(discovered(docs, rows, **options).select("instance"), "pii-found")
    if found.isEmpty():
        out = docs.mapInArrow(lambda x: _redact_batches(x, None), docs.schema)
    else:
        ids = (rows.select("key", F.explode("others").alias("e")).select("key", "e.instance").join(found, "instance")
               .groupBy(F.col("key").alias("__key")).agg(F.collect_set("instance").alias("__ids")))
        none = F.expr("CAST(array() AS array<string>)")
        out = (docs.withColumn("__key", _key()).join(ids, "__key", "left").drop("__key")
               .withColumn("__ids", F.coalesce("__ids", none))
               .mapInArrow(lambda x: _redact_batches(x, "__ids"), docs.schema))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
