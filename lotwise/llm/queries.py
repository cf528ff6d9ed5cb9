"""One query for each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotwise.llm import (
    bpe,
    collocations,
    fim,
    hnsw,
    language,
    planes,
    raking,
    repeats,
    secrets,
    simhash,
    threshold,
    url_rules,
    warc,
)
from lotwise.llm.shared import table_of, whole_text

# What the queries' contracts set.
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
# Word pieces a task remembers where encoding is all it does.
PIECES_ALONE = 600_000
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
REVISIT_BYTES = 1000
LINK_SHINGLE, LINK_BITS = 3, 2
EVERY, TOP = 50, 5
FOLDS = 5
WINDOW_WORDS = 20
LEAST_COUNT, LONGEST, HELD_PERCENT, LISTED = 30, 4, 80, 2000

# Targets of the mix: shares of tokens. Values not named keep their own share.
TARGETS = {
    "source": {"src0": 0.24} | {f"src{i}": 0.04 for i in range(1, 20)},
    "lang": {"en": 0.52, "fr": 0.17, "de": 0.17, "es": 0.14},
    "topic": {str(i): 0.1 for i in range(10)},
}


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents")
    manifest = planes.write_shards(documents, vocabulary_path(), end_id=END_ID)
    return planes.read_shards(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op2_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table_of(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_rules.judge(pages, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(documents, room=PIECES_ALONE).drop("token_ids")


def token_digests(documents: DataFrame, room: int = bpe.KEPT_PIECES) -> DataFrame:
    """Ids of each document, and digests of them and of the text decoded from them."""
    encoded = bpe.encode_documents(
        documents, vocabulary_path(), decoded_into="decoded", room=room
    )
    return encoded.select(
        "doc_id",
        F.floor(F.length("token_ids") / 4).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        "token_ids",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table_of(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, min_bytes=REVISIT_BYTES)
    return warc.read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(documents, words_path=vocabulary_path())
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] != "guess")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, secrets.KINDS),
        F.sha2(F.encode(secrets.spelled(base), "UTF-8"), 256).alias("base_sha256"),
        secrets.spelled(spans).alias("spans"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = simhash.near_groups(documents, shingle=LINK_SHINGLE, max_bits=LINK_BITS)
    digits = F.lower(F.lpad(F.hex(F.col("simhash")[0]), 16, "0"))
    return grouped.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table_of(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, F.col("vec_id") % EVERY == 0, k=TOP)


def op8_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table_of(spark, sf_dir, "embeddings")
    return threshold.top_scores(vectors, F.col("vec_id") % EVERY == 0, k=TOP)


def held_out():
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS == 0


def learned_language(documents: DataFrame) -> language.Profiles | None:
    """Profiles from the labelled documents that are not held out."""
    return language.learn(documents.filter(~F.coalesce(held_out(), F.lit(False))))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents")
    profiles = learned_language(documents.select("doc_id", "text", "lang"))
    found = language.identify(documents.select("doc_id", "text"), profiles)
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def mixed(spark: SparkSession, sf_dir: str, documents: DataFrame) -> DataFrame:
    """Documents with tokens, topic, weight and probability for the fixed targets.

    A document's topic is the label of the vector that has its id."""
    vectors = table_of(spark, sf_dir, "embeddings")
    topics = vectors.groupBy(F.col("vec_id").alias("doc_id")).agg(
        F.min("label").cast("string").alias("topic")
    )
    return raking.with_probability(
        documents.join(topics, "doc_id", "left"), TARGETS, tokens="tokens"
    )


def op10_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        raking.token_count(F.col("text")).alias("tokens"),
        F.xxhash64(whole_text()).alias("mark"),
    )
    weighed = mixed(spark, sf_dir, documents)
    keep = raking.drawn(F.col("probability"), F.col("doc_id"), F.col("mark"))
    return weighed.select(
        "doc_id", "source", "lang", "topic", "tokens", "weight", "probability", keep.alias("kept")
    )


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.without_repeats(documents, length=WINDOW_WORDS)
    kept = F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = collocations.collocations(
        documents, least=LEAST_COUNT, longest=LONGEST, percent=HELD_PERCENT
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= LISTED)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table_of(spark, sf_dir, "documents").select("doc_id", "text")
    made = fim.fill_in_middle(documents)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(fim.restored(), "UTF-8"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_id_planes": op1_id_planes,
    "op2_url_cascade": op2_url_cascade,
    "op3_bpe": op3_bpe,
    "op4_warc": op4_warc,
    "op5_secrets": op5_secrets,
    "op6_simhash": op6_simhash,
    "op7_hnsw": op7_hnsw,
    "op8_threshold": op8_threshold,
    "op9_language": op9_language,
    "op10_raking": op10_raking,
    "op11_repeats": op11_repeats,
    "op12_collocations": op12_collocations,
    "op13_fim": op13_fim,
}

ORACLES = {
    "op2_url_cascade": """
with cut as (
  select page_id, coalesce(case when position('://' in url) > 0
    then regexp_extract(substr(url, position('://' in url) + 3), '^[^?#]*') end, '') as rest
  from pages),
parts as (
  select page_id, regexp_extract(rest, '^[^/]*') as raw,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) as path
  from cut),
named as (
  select page_id, path,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
  from parts),
rules(rule_host, rule_path, rule_verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits as (
  select n.*, rule_host || rule_path as rule, rule_verdict
  from named n left join rules
    on starts_with(path, rule_path) and (host = rule_host or ends_with(host, '.' || rule_host))),
ranked as (
  select *, row_number() over (partition by page_id order by length(rule) desc nulls last) as place
  from fits)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from ranked where place = 1
""",
    "op4_warc": """
with payloads as (
  select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
    sha1(coalesce(html, '')) as payload_digest
  from pages),
groups as (
  select *, max(page_id) over (partition by payload_digest) as whole from payloads)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> whole then 'revisit' else 'response' end
    as record_type,
  case when payload_bytes >= 1000 and page_id <> whole then whole end as refers_to
from groups
""",
    "op8_threshold": """
with vectors as (
  select vec_id, list_transform(embedding,
    lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
  from vectors q join vectors c
    on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)),
ranked as (
  select query_id,
    cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
    vec_id, score
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
""",
    "op11_repeats": r"""
with cut as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 18)) as i, w from cut where len(w) >= 20),
spelled as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as s from windows),
again as (
  select doc_id, i from spelled qualify row_number() over (partition by s order by doc_id, i) > 1),
lost as (select distinct doc_id, unnest(range(i, i + 20)) as place from again),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from cut),
kept as (
  select doc_id, string_agg(word, ' ' order by place) as kept, count(*) as n_kept
  from words anti join lost using (doc_id, place) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n_kept, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from cut left join kept using (doc_id)
""",
    "op12_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
sized as (select lang, w, unnest([1, 2, 3, 4]) as size from words),
runs as (
  select lang, size, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
  from sized where len(w) >= size),
counted as materialized (
  select lang, size, phrase, lang || ':' || phrase as name, count(*) as a from runs group by all),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
cuts as (
  select c.*, string_split(phrase, ' ') as w, k.k
  from counted c join (values (1), (2), (3)) k(k) on k.k < c.size
  where c.a >= 30 and c.size >= 2),
weighed as (
  select c.lang, c.size, c.phrase, c.a, c.k, l.a as l, r.a as r,
    cast((2000000::hugeint * c.a) // (l.a::hugeint + r.a) as bigint) as score
  from cuts c join counted l on l.name = c.lang || ':' || array_to_string(c.w[1:c.k], ' ')
    join counted r on r.name = c.lang || ':' || array_to_string(c.w[c.k + 1:c.size], ' ')),
best as materialized (
  select * from weighed
  qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_runs as (
  select b.lang, b.a, array_to_string(list_slice(string_split(b.phrase, ' '), i.i, i.i + k.k - 1), ' ')
    as phrase
  from best b join (values (2), (3)) k(k) on k.k < b.size
    join (values (1), (2), (3)) i(i) on i.i + k.k - 1 <= b.size),
longer as (select lang, phrase, max(a) as most from inner_runs group by lang, phrase),
kept as (
  select b.* from best b left join longer x on x.lang = b.lang and x.phrase = b.phrase
  where x.most is null or 100::hugeint * x.most < 80::hugeint * b.a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank
  from kept)
select r.lang, rank, phrase, a, l, r, n, score
from ranked r join totals t on t.lang = r.lang where rank <= 2000
""",
    "op13_fim": r"""
with cut as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as digest
  from documents),
drawn as (
  select *, len(units) as n,
    cast('0x' || substr(digest, 1, 8) as bigint) as h1, cast('0x' || substr(digest, 9, 8) as bigint) as h2,
    cast('0x' || substr(digest, 17, 8) as bigint) as h3, cast('0x' || substr(digest, 25, 8) as bigint) as h4
  from cut),
parts as (
  select *, array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') as prefix,
    array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '')
      as middle,
    array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') as suffix,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
      or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
""",
}
