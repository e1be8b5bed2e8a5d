"""One query per operator over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid.llm import (
    bpe,
    chat,
    decontaminate,
    exact_dedup,
    lexical,
    licenses,
    line_dedup,
    mixing,
    periodic,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from stopgrid.llm.common import text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed value: where A-Z alone is lower-cased, for SQL.
SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Fixed value: the words of decontamination and licence scans, for SQL.
SQL_WORDS = rf"regexp_extract_all({SQL_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)
    return groups.select(
        F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op2_token_counts")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


@query("op3_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = bpe.round_trip(text_of(), tokenizer_path("word_bpe_49k.json"))
    return docs.select("doc_id", done.alias("done")).select("doc_id", "done.*")


@query(
    "op4_exact_dedup",
    f"""
    with d as (select doc_id, sha256({SQL_LOWER}) as text_sha256 from documents)
    select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
           doc_id is not distinct from max(doc_id) over g as kept, text_sha256
    from d window g as (partition by text_sha256)
    """,
)
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = exact_dedup.mark(table(spark, sf_dir, "documents"))
    return marks.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@query(
    "op6_decontaminate",
    f"""
    with d as (select doc_id, {SQL_WORDS} as w from documents),
    b as (select distinct item_id, {SQL_WORDS} as w from benchmark where item_id is not null),
    windows as (
        select distinct item_id, least(len(w), 10) as n,
               list_slice(w, s, s + least(len(w), 10) - 1) as phrase
        from b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(s) where len(w) > 0
    ),
    places as (
        select doc_id, s, n, list_slice(w, s, s + n - 1) as phrase
        from d, (select distinct n from windows) l, unnest(range(1, len(w) - n + 2)) t(s)
    ),
    hits as (select distinct p.doc_id, p.s, p.n, item_id from places p join windows using (n, phrase)),
    covered as (
        select doc_id, count(distinct s + k) as n_hit from hits, unnest(range(0, n)) t(k) group by doc_id
    ),
    found as (
        select doc_id, count(distinct item_id) as n_items,
               sha256(string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))) as items_sha256
        from hits group by doc_id
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated
    from d left join covered using (doc_id) left join found using (doc_id)
    """,
)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.search(docs.select("doc_id", "text"), benchmark, width=10).withColumn("n", decontaminate.n_hit())
    names = F.array_sort(F.transform("hits.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.col("n").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(names, ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n") > 0).alias("contaminated"),
    )


@query(
    "op7_warc",
    """
    with p as (
        select page_id, coalesce(html, '') as payload, coalesce(url, '') as url, sha256(coalesce(html, '')) as payload_digest from pages
    ),
    g as (
        select *, strlen(payload) as payload_bytes,
               first_value(page_id) over w as first_id, first_value(url) over w as first_url
        from p window w as (partition by payload_digest order by page_id nulls last, url)
    )
    select page_id, payload_bytes, payload_digest,
           case when revisit then 'revisit' else 'response' end as record_type,
           case when revisit then first_id end as refers_to
    from (select *, payload_bytes >= 100 and (page_id is distinct from first_id or url <> first_url) as revisit from g)
    """,
)
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), folder)
    records = warc.read(spark, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_toxicity")
def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def _license_sql() -> str:
    """Every template at every place where its first mandatory word stands, counted out."""
    rows = []
    for which, p in enumerate(licenses.postings()):
        for i, (word, must) in enumerate(zip(p.words, p.must)):
            rows.append(f"({which}, '{p.label}', {p.base}, {i}, '{word}', {must}, {p.must.index(True)})")
    return f"""
    with p(which, label, base, i, word, must, lead) as (values {", ".join(rows)}),
    d as (select doc_id, {SQL_WORDS} as w from documents),
    df as (select word, count(*) as n from (select distinct doc_id, unnest(w) as word from d) group by word),
    idf as (
        select word, ln((1.0 + (select count(*) from d)) / (1 + coalesce(n, 0))) + 1 as idf
        from (select distinct word from p) left join df using (word)
    ),
    spots as (select doc_id, w, unnest(range(len(w))) as k from d),
    starts as (select doc_id, w, which, k - lead as start from spots join p on p.i = p.lead and w[k + 1] = p.word),
    judged as (
        select doc_id, which, start, label, base, bool_and(met or not must) as whole,
               sum(case when met then idf else 0 end) / sum(idf) as score
        from (
            select *, start + i >= 0 and coalesce(w[start + i + 1] = word, false) as met
            from starts join p using (which) join idf using (word)
        ) group by all
    ),
    found as (select * from judged where whole and score >= {licenses.MIN_SCORE - 1e-9}),
    per as (
        select doc_id, count(*) filter (base) as n_base, min(start) filter (base) as first_word,
               max(start) filter (base) as last_word,
               coalesce(string_agg(distinct label, ',' order by label) filter (base), '') as base_labels,
               string_agg(distinct label, ',' order by label) as labels, max(score) as score
        from found group by doc_id
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
           coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
           round(coalesce(score, 0), 6) as score
    from d left join per using (doc_id)
    """


@query("op10_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 6)).withColumnRenamed("id", "doc_id")


@query(
    "op8_line_dedup",
    r"""
    with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
    l as (select doc_id, no, ls[no + 1] as line from (select doc_id, ls, unnest(range(len(ls))) as no from d)),
    o as (
        select *, string_split(norm, ' ') as w, doc_id * 1000000 + no as place
        from (select *, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) as norm from l)
    ),
    c as (select norm, any_value(w) as w, min(place) as first from o where norm <> '' and len(w) >= 8 group by norm),
    v as (
        select norm, first, len(w) as n, i, array_to_string(list_concat(w[1:i], w[i + 2:]), ' ') as key
        from c, unnest(range(len(w))) t(i)
    ),
    near as (
        select norm from (select norm, first, min(first) over (partition by n, i, key) as m from v) where m < first
        union select v.norm from v join c on v.key = c.norm where c.first < v.first
        union select c.norm from v join c on v.key = c.norm where v.first < c.first
    ),
    judged as (
        select o.*, c.first is not null and (near.norm is not null or o.place > c.first) as dropped
        from o left join c using (norm) left join near using (norm)
    )
    select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by no) filter (not dropped), '')) as text_sha256
    from judged group by doc_id
    """,
)
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the SQL knows lines of eight words or more alone
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=None)
    return found.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256")
    )


@query(
    "op5_chat_format",
    """
    with t as (
        select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations
    ),
    r as (select *, row_number() over (partition by conv_id order by turn nulls last, role, text) - 1 as position from t),
    s as (select conv_id, count(*) as n, list(struct_pack(role := role, text := text) order by position) as c from r group by conv_id),
    w as (select min(conv_id) as conv_id, n, c, count(*) as n_logged from s group by n, c),
    m as (
        select conv_id, n, n_logged from w
        where not exists (select 1 from w b where b.n > w.n and b.c[1] = w.c[1] and list_slice(b.c, 1, w.n) = w.c)
    )
    select r.conv_id, position, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as segment,
           n as n_turns, n_logged
    from r join m using (conv_id)
    """,
)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op11_context_mixing")
def context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(7)) == 2
    found = mixing.score(docs, mixing.fit(docs, held_out), held_out)
    return found.select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
        (F.col("bits") * F.lit(-math.log10(2))).alias("score"), "n_bytes",
        (F.col("bits") / F.nullif(F.col("n_bytes"), F.lit(0))).alias("bits_per_byte"),
    )


#: Fixed value: the terms of ranked search, for SQL.
SQL_TERMS = rf"regexp_extract_all({SQL_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op13_lexical_search",
    f"""
    with d as (select doc_id, {SQL_TERMS} as w from documents),
    b as (select item_id, {SQL_TERMS} as w from benchmark),
    lens as (select doc_id, len(w) as n from d where len(w) > 0),
    total as (select count(*) as n_docs, cast(sum(n) as bigint) as n_all from lens),
    tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from d) group by all),
    df as (select term, count(*) as df from tf group by term),
    asked as (select item_id, term, count(*) as repeats from (select item_id, unnest(w) as term from b) group by all),
    scored as (
        select item_id, doc_id, cast(sum(
            repeats * cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / (2 * df + 1))) as bigint)
            * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_all)))
        ) as bigint) as score
        from asked join df using (term) join tf using (term) join lens using (doc_id), total
        group by item_id, doc_id
    )
    select item_id, cast(rank as int) as rank, doc_id, score from (
        select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0
    ) where rank <= 10
    """,
)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return found.select(F.col("query").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


#: Fixed value: CRC-32 of a number's decimal digits, for SQL.
SQL_CRC32 = """
    xor(4294967295::bigint, list_reduce(
        list_concat([4294967295::bigint], list_transform(range(1, len(cast(doc_id as varchar)) + 1), lambda i: ascii(substr(cast(doc_id as varchar), i, 1))::bigint)),
        lambda c, b: list_reduce(
            list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384::bigint * (x & 1))
        )
    ))
"""


def _made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text); of every tenth document, by a checksum of its id, a part of its words repeats to the end."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    blanks = F.translate(text_of(), "\t\n\x0b\x0c\r", "     ")
    words = F.filter(F.split(blanks, " ", -1), lambda w: w != "")
    split = docs.select("doc_id", text_of().alias("text"), F.floor(h / 10).alias("g"), F.when(F.pmod(h, F.lit(10)) == 0, words).alias("w"))
    n = F.size("w").cast("long")
    a = F.pmod(F.col("g"), n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(F.col("g"), F.lit(8))))
    piece = F.slice("w", (a + 1).cast("int"), p.cast("int"))
    tail = F.flatten(F.array_repeat(piece, F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice("w", F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
    return split.select("doc_id", F.when(F.size("w") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


@query(
    "op12_periodic_runs",
    rf"""
    with d as (
        select doc_id, {SQL_CRC32} as h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
    ),
    a as (select *, h // 10 as g, (h // 10) % greatest(len(w), 1) as a from d),
    b as (select *, 1 + (len(w) - a) // (3 + g % 8) as p from a),
    t as (
        select doc_id, case when h % 10 = 0 and len(w) > 0
            then list_transform(range(len(w)), lambda i: w[1 + case when i >= a then a + (i - a) % p else i end]) else w end as w
        from b
    ),
    grams as (select doc_id, i, array_to_string(w[i + 1:i + 6], ' ') as gram from t, unnest(range(len(w) - 5)) u(i) where len(w) >= 12),
    pairs as (select x.doc_id, x.i, y.i - x.i as q from grams x join grams y on x.doc_id = y.doc_id and x.gram = y.gram and y.i > x.i),
    chains as (select *, i - row_number() over (partition by doc_id, q order by i) as chain from pairs),
    stretches as (select doc_id, q, min(i) as start, count(*) + 5 + q as length from chains group by doc_id, q, chain),
    runs as (
        select doc_id, start, length, min(q) as period from stretches where length >= greatest(12, 2 * q) group by doc_id, start, length
    ),
    told as (
        select doc_id, count(*) as n_runs, first(struct_pack(start, length, period) order by length desc, start, period) as longest,
               string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as said
        from runs group by doc_id
    ),
    gone as (select distinct doc_id, k from runs, unnest(range(start + period, start + length)) u(k)),
    words as (select doc_id, k, w[k + 1] as word from t, unnest(range(len(w))) u(k)),
    kept as (
        select doc_id, string_agg(word, ' ' order by k) as collapsed
        from words anti join gone using (doc_id, k) group by doc_id
    )
    select doc_id, coalesce(n_runs, 0) as n_runs, longest.start as start, longest.length as length, longest.period as period,
           (1000 * longest.length) // longest.period as exponent_milli, sha256(coalesce(said, '')) as runs_sha256,
           sha256(coalesce(collapsed, '')) as collapsed_sha256
    from t left join told using (doc_id) left join kept using (doc_id)
    """,
)
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _made_periodic(table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", periodic.periodic_runs(F.col("text")).alias("found"))
    runs = F.col("found.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    said = F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("found.collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-F.col("longest.col2")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.col3")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.col3")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
