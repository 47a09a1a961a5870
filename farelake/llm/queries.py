"""The registered queries of the operators, with production parameters, and their SQL twins."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat_format, decontaminate, exact_dedup, html_extract, line_dedup, minhash, packing, periodic, quality, ranked_search, sharding
from .common import LOWER, UPPER, read_table, text_or_empty


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document; the largest doc_id stays."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), vocabulary)
    both = bpe.decode(encoded.select(F.struct("doc_id", "ids").alias("_row"), "ids"), vocabulary, "_row")
    return both.select(
        "_row.doc_id", (F.octet_length("_row.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("_row.ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines that repeat earlier documents, and digests of what is left of its text."""
    cleaned = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "deleted_lines", F.size("deleted_lines").cast("long").alias("n_deleted"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


#: Conversation -7 of the contract: both turns say this.
PLANTED_TURN = "\\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from every formatted conversation."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED_TURN), (-7, 1, "assistant", PLANTED_TURN)], turns.schema)
    formatted = chat_format.format_chats(turns.unionByName(planted))

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv_id, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = chat_format.read_turns(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in pairs).encode()
                loss = "".join(chat_format.read_loss(text, starts, ends))
                out.append((conv_id, len(pairs), hashlib.sha256(whole).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            if out:
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                kinds = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(read_back, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A document with a score below this is rejected.
QUALITY_THRESHOLD = 0.3


def quality_network(spark: SparkSession, sf_dir: str) -> quality.Network:
    return quality.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    scored = quality.score(read_table(spark, sf_dir, "documents"), quality_network(spark, sf_dir))
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of every document."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences of 2048."""
    return packed_documents(read_table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return packing.pack(pieces)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors to every vector whose id is divisible by 100."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of near equal bytes; equal texts together."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=16)


def planted_repeats(docs: DataFrame) -> DataFrame:
    """The documents whose id's crc32 is divisible by 10 repeat themselves from some word on, as the contract of op11 says."""
    words = F.array_remove(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), "")
    h, n = F.crc32(F.col("doc_id").cast("string")), F.size(words).cast("long")
    g = F.floor(h / 10)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    times = F.ceil((n - a) / p)
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), times.cast("int"))), F.lit(1), (n - a).cast("int"))
    text = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), repeated), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's periodic runs, its strongest run, and of its words without the repeats."""
    found = periodic.find_runs(planted_repeats(read_table(spark, sf_dir, "documents")))
    # the first of the greatest exact exponent, as the runs lie by start and period
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, x: F.when(x["length"] * b["period"] > b["length"] * x["period"], x).otherwise(b))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return ranked_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document holds of the benchmark's windows of ten words."""
    found = decontaminate.find_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_bpe": op2_bpe,
    "op3_html_extract": op3_html_extract,
    "op4_line_dedup": op4_line_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_quality": op6_quality,
    "op7_minhash": op7_minhash,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_ann": op9_ann,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_decontaminate": op13_decontaminate,
}

#: Terms of op12 and words of op13, for texts that are in lower case.
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op1_exact_dedup": f"""
        with n as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from n
    """,
    "op5_chat_format": r"""
        with c as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               cast(sum(14 + 2 * length(role) - length(translate(role, '\#<' || chr(10), '')) + 2 * length(text) - length(translate(text, '\#<', ''))) as bigint) as formatted_chars
        from c group by conv_id
    """,
    "op12_ranked_search": f"""
        with dt as (
            select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) as term from documents),
        it as (
            select item_id, term, count(*) as times from (
                select item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) as term from benchmark)
            group by item_id, term),
        lengths as (select doc_id, count(*) as n from dt group by doc_id),
        total as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from lengths),
        postings as (select doc_id, term, count(*) as tf from dt where term in (select term from it) group by doc_id, term),
        weights as (
            select term, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
            from postings, total group by term, big_n),
        scored as (
            select item_id, doc_id,
                   cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l))))) as bigint) as score
            from it join postings using (term) join weights using (term) join lengths using (doc_id), total
            group by item_id, doc_id)
        select item_id, cast(rank as int) as rank, doc_id, score from (
            select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
            from scored where score > 0)
        where rank <= 20
    """,
    "op13_decontaminate": f"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') as words from documents),
        b as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') as words from benchmark),
        iw as (
            select item_id, least(10, len(words)) as width, words, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) as i
            from b where len(words) > 0),
        windows as (select distinct item_id, width, array_to_string(words[i : i + width - 1], ' ') as win from iw),
        places as (
            select doc_id, width, i, array_to_string(words[i : i + width - 1], ' ') as win from (
                select doc_id, words, width, unnest(generate_series(1, len(words) - width + 1)) as i
                from d, (select distinct width from windows) where len(words) >= width)),
        found as (select p.doc_id, w.item_id, p.i, p.width from places p join windows w on p.width = w.width and p.win = w.win),
        hits as (
            select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(generate_series(i, i + width - 1)) as k from found) group by doc_id),
        items as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
            from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
        select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(listed, '')) as items_sha256, n_hit is not null as contaminated
        from d left join hits using (doc_id) left join items using (doc_id)
    """,
}
