"""Personal data, and the words that give it away.

Addresses, card and phone numbers are found by their form. What else tells about
them is learnt from the corpus: words within ``WORDS`` words of an entity (an address or
number, by its value) are terms of its contexts. With IC(e) = -log p(e), a term t
discloses the share (IC(e) - IC(e|t)) / IC(e) of an entity, where p(e) is the number of
different contexts of e among all different texts and p(e|t) the part of the texts with t
that hold t in such a context. At ``REMOVE`` the term is taken out near that entity, at
``GENERALISE`` it is replaced by its kind. Equal contexts and equal texts count once, so copies
prove nothing and dilute nothing, and ``EVIDENCE`` different contexts are needed.

Contexts and counts are aggregated before each shuffle. The words of all documents are
counted in the tasks and only sums of terms that matter travel, or for texts that occur more
than once, a row for each text and term. Texts are shuffled only if more than
``BROADCAST_HASHES`` of them do.

A null text is empty. Repeated rows each give their row. Rows without an id are read like
others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, query, small_batches, table, text_hash

#: Words on each side of an entity that make its context, within so many characters.
WORDS, REACH = 8, 200
#: Different contexts that must show a term next to an entity.
EVIDENCE = 3
#: Shares of an entity's information.
GENERALISE, REMOVE = 0.75, 0.9
#: Words a task counts before it passes the counts on.
HELD_WORDS = 200_000
#: Terms that may be broadcast; more of them are joined by shuffling.
BROADCAST_ROWS = 50_000
#: Hashes of repeated texts that may be broadcast.
BROADCAST_HASHES = 500_000

#: Kinds in the order of the contract.
KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")

FOUND = (
    "doc_id bigint, text_hash bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, base_sha256 string, "
    "contexts array<struct<entity:bigint,term:string,context:bigint,start:bigint,end:bigint>>"
)
CONTEXTS = pa.list_(
    pa.struct([("entity", pa.int64()), ("term", pa.string()), ("context", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
)


def emails(text: str):
    """The pattern in time linear in the text: what stands before each @ is looked for backwards."""
    done = 0
    for m in AT.finditer(text):
        at, size = m.start(), 64
        while True:
            low = max(done, at - size)
            start = low + len(text[low:at].rstrip(LOCAL))
            if start > low or low == done:
                break
            size *= 4
        if start < at:
            yield start, m.end()
            done = m.end()


def addresses(text: str):
    for m in NUMBERS.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, start = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            # Leading zeros aside, a part of more than three digits is too large.
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str):
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with 18 marks
            digits = re.sub("[ -]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


FINDERS = (emails, addresses, cards, phones)


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, in order."""
    return sorted((s, k, e) for k, find in enumerate(FINDERS) for s, e in find(text))


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def number(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def contexts(text: str, found: list[tuple[int, int, int]]) -> list[dict]:
    """Terms around each entity; parts of base spans are no terms."""
    out: list[dict] = []
    taken = [(s, e) for s, _, e in found]
    for i, (start, kind, end) in enumerate(found):
        value = text[start:end].lower() if kind < 2 else re.sub("[^0-9]", "", text[start:end])
        low, high = max(0, start - REACH), min(len(text), end + REACH)
        before = [m for m in TERM.finditer(text, low, start) if m.start() > low or not low][-WORDS:]
        after = [m for m in TERM.finditer(text, end, high) if m.end() < high or high == len(text)][:WORDS]
        terms = [m for m in before + after if not any(s < m.end() and m.start() < e for s, e in taken[max(0, i - WORDS) : i + WORDS + 1])]
        context = number(" ".join(m[0].lower() for m in terms))
        entity = number(f"{KINDS[kind]}:{value}")
        out += ({"entity": entity, "term": m[0].lower(), "context": context, "start": m.start(), "end": m.end()} for m in terms)
    return out


def _find(batches):
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for text in batch.column("text").to_pylist():
            found = spans(text or "")
            kinds = [k for _, k, _ in found]
            base = joined(found)
            row = [*map(kinds.count, range(4)), base, hashlib.sha256(base.encode()).hexdigest(), contexts(text or "", found)]
            for column, value in zip(columns, row):
                column.append(value)
        types = (*[pa.int64()] * 4, pa.string(), pa.string(), CONTEXTS)
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *arrays], [c.split()[0] for c in FOUND.split(", ")])


def _words(batches):
    """Texts with each term (``n``), and by ``copied`` hash a row for each term of a text that has copies."""
    held: dict[str, int] = {}
    seen: set[int] = set()

    def rows(copied, terms, n):
        return pa.RecordBatch.from_arrays([pa.array(copied, pa.int64()), pa.array(terms, pa.string()), pa.array(n, pa.int64())], ["copied", "term", "n"])

    for batch in batches:
        for copied, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if copied in seen:
                continue
            words = set(TERM.findall(text.lower() if text else ""))
            if copied is None:
                for w in words:
                    held[w] = held.get(w, 0) + 1
            else:
                if len(seen) > HELD_WORDS:
                    seen.clear()
                seen.add(copied)
                yield rows([copied] * len(words), list(words), [1] * len(words))
        if len(held) > HELD_WORDS:
            yield rows([None] * len(held), list(held), list(held.values()))
            held = {}
    yield rows([None] * len(held), list(held), list(held.values()))


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """To be broadcast if it has been counted to be small."""
    return F.broadcast(df) if df.count() <= limit else df


def texts_with(docs: DataFrame, found: DataFrame, terms: DataFrame) -> tuple[DataFrame, int]:
    """Number of different texts with each term (``_term``, ``n_term``), and of all."""
    texts = cut(found.groupBy("text_hash").agg(F.count("*").alias("n")))
    copies = bounded(cut(texts.filter("n > 1").select(F.col("text_hash").alias("copied"))), BROADCAST_HASHES)
    read = small_batches(docs).select(text_hash().alias("text_hash"), "text")
    read = read.join(copies, F.col("text_hash") == F.col("copied"), "left").select("copied", "text")
    counted = read.mapInArrow(_words, "copied bigint, term string, n bigint").join(terms, "term")
    # Of a text with copies, the rows of several tasks are one.
    once = counted.groupBy("copied", "term").agg(F.sum("n").alias("n"))
    n_term = F.sum(F.when(F.col("copied").isNull(), F.col("n")).otherwise(1))
    return once.groupBy(F.col("term").alias("_term")).agg(n_term.alias("n_term")), texts.count()


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``entity``, ``term``, ``disclosure``, ``action`` of the terms beyond a threshold."""
    seen = found.select(F.explode("contexts").alias("c")).select("c.entity", "c.term", "c.context").distinct()
    pairs = seen.groupBy("entity", "term").agg(F.count("*").alias("together")).filter(F.col("together") >= EVIDENCE)
    sizes = seen.select(F.col("entity").alias("_entity"), "context").distinct().groupBy("_entity").agg(F.count("*").alias("n_entity"))
    pairs = cut(pairs.join(sizes, F.col("entity") == F.col("_entity")))
    terms = bounded(cut(pairs.select("term").distinct()))
    df, texts = texts_with(docs, found, terms)
    total = F.lit(float(max(1, texts)))
    told = pairs.join(df, F.col("term") == F.col("_term"))
    ic = -F.log(F.least(F.col("n_entity") / total, F.lit(1.0)))
    left = -F.log(F.least(F.col("together") / F.col("n_term"), F.lit(1.0)))
    told = told.withColumn("disclosure", F.when(ic > 0, (ic - left) / ic).otherwise(F.lit(0.0)))
    action = F.when(F.col("disclosure") >= REMOVE, "remove").when(F.col("disclosure") >= GENERALISE, "generalise")
    return cut(told.withColumn("action", action).filter("action IS NOT NULL").select("entity", "term", "disclosure", "action"))


def find_private(docs: DataFrame) -> DataFrame:
    """One row per document: its base spans, and ``terms``, the places of disclosing words."""
    read = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), "text")
    rows = cut(read.mapInArrow(_find, FOUND).withColumn("row", F.monotonically_increasing_id()))
    told = disclosing(docs, rows)
    told = bounded(told.select(F.col("entity").alias("_entity"), F.col("term").alias("_term"), "action"))
    places = rows.filter(F.size("contexts") > 0).select(F.col("row").alias("_row"), F.explode("contexts").alias("c"))
    hits = places.join(told, (F.col("c.entity") == F.col("_entity")) & (F.col("c.term") == F.col("_term")))
    # A word may stand by two entities: what is taken out by one is taken out.
    one = hits.groupBy("_row", "c.start", "c.end").agg(F.max("action").alias("action"))
    terms = one.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))
    return rows.drop("contexts").join(terms, F.col("row") == F.col("_row"), "left").drop("_row")


def all_spans(base: Column, terms: Column) -> Column:
    """Base spans and terms as text, by start, then kind."""
    parsed = F.transform(
        F.filter(F.split(base, ","), lambda x: x != ""),
        lambda x: F.struct(
            F.split_part(x, F.lit(":"), F.lit(2)).cast("bigint").alias("start"),
            F.array_position(F.array(*map(F.lit, KINDS)), F.split_part(x, F.lit(":"), F.lit(1))).cast("int").alias("kind"),
            x.alias("text"),
        ),
    )
    more = F.transform(
        F.coalesce(terms, F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")),
        lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), F.concat_ws(":", F.lit("term"), x["start"], x["end"]).alias("text")),
    )
    return F.array_join(F.transform(F.sort_array(F.concat(parsed, more)), lambda x: x["text"]), ",")


def redact(text: str, base: str, terms: list[tuple[int, int, str]]) -> str:
    """The text with entities and disclosing words replaced by their kind, or taken out."""
    marks = []
    for part in filter(None, base.split(",")):
        kind, start, end = part.split(":")
        marks.append((int(start), int(end), f"[{kind.upper()}]"))
    marks += [(s, e, "" if action == "remove" else "[NAME]" if text[s].isupper() else "[WORD]") for s, e, action in terms]
    out, at = [], 0
    for start, end, instead in sorted(marks):
        if end <= at:
            continue
        out += (text[at : max(at, start)], instead)
        at = end
    return "".join([*out, text[at:]])


def _redact(batches):
    for batch in batches:
        texts = []
        for text, base, terms in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "terms"))):
            texts.append(text and redact(text, base or "", [(t["start"], t["end"], t["action"]) for t in terms or ()]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def sanitise(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the sanitised ``text`` of every document."""
    found = find_private(docs).filter("base != '' OR terms IS NOT NULL").dropDuplicates(["doc_id", "text_hash"])
    found = cut(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "base", "terms"))
    read = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), "text")
    joined_rows = read.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined_rows.select("doc_id", "text", "base", "terms").mapInArrow(_redact, "doc_id bigint, text string")


@query()
def op1_pii(spark, sf):
    found = find_private(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", all_spans(F.col("base"), F.col("terms")).alias("spans"),
        F.coalesce(F.size("terms"), F.lit(0)).cast("bigint").alias("n_term"),
    )
