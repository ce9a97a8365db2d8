"""Registered queries of the operators and their SQL checks."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import alignment, classifier, exact, jaccard, lm, mixing, packing, phrases, pieces, quality, substring, urls, warc
from tidegate.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "base_failed", "kept", "lost_words")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"), width=3, threshold=0.9)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.groups(table(spark, sf_dir, "documents"))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", sha)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return found.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_bytes"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, piece = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.measure(table(spark, sf_dir, "documents"), byte_level, piece)


OPERATORS = (
    op1_quality_rules,
    op2_ngram_jaccard,
    op3_warc,
    op4_mixing,
    op5_lm_scoring,
    op6_url_filters,
    op7_substring_dedup,
    op8_quality_classifier,
    op9_exact_dedup,
    op10_packing,
    op11_phrases,
    op12_sentencepiece,
    op13_tokenizer_alignment,
)
QUERIES = {q.__name__: q for q in OPERATORS} | {"pipeline": corpus_pipeline.run}

OP1 = rf"""
with d as (
  select row_number() over () as id, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\x0c\r]+') as own
  from documents
), lines as (
  select id, unnest(string_split(text, chr(10))) as line from d
), judged as (
  select id, line, len(regexp_extract_all(line, '[^ \t\n\x0b\x0c\r]+')) as n,
    len(regexp_extract_all(line, $q${quality.SEPARATOR.replace("x20", "x{20}").replace("x09", "x{09}")}$q$)) as separators
  from lines where regexp_matches(line, '[^ \t\n\x0b\x0c\r]')
), failed as (
  select id, line, n, not regexp_matches(line, $q${quality.SENTENCE_END}$q$)
    or len(regexp_extract_all(line, $q${quality.NOISE}$q$)) * 10 > n * 3
    or (separators >= 2 and separators * 5 >= n) or (n <= 4 and regexp_matches(lower(line), $q${quality.MENU}$q$))
    or (n <= {quality.SHORT_LINE} and regexp_matches(lower(line), $q${quality.BOILERPLATE}$q$)) as fails
  from judged
), by_line as (
  select id, count(*) - count(distinct line) as n_dup_lines, coalesce(sum(n) filter (where fails), 0) as lost from failed group by id
), placed as (
  select id, unnest(own) as w, generate_subscripts(own, 1) as i from d
), keyed as (
  select id, i, w || ' ' || lead(w, 1) over p || ' ' || lead(w, 2) over p || ' ' || lead(w, 3) over p || ' ' || lead(w, 4) over p || ' ' || lead(w, 5) over p || ' ' || lead(w, 6) over p || ' ' || lead(w, 7) over p as words from placed
  window p as (partition by id order by i)
), windows as (
  select id, i, count(*) over (partition by id, words) as found from keyed where words is not null
), steps as (
  select id, least(8, coalesce(lead(i) over (partition by id order by i) - i, 8)) as step from windows where found > 1
), repeated as (
  select id, sum(step) as n from steps group by id
), counted as (
  select doc_id, len(own)::bigint as n_words, length(array_to_string(own, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, coalesce(lost, 0)::bigint as lost_words
  from d left join by_line using (id) left join repeated using (id)
), based as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
)
select *, not base_failed and 100 * lost_words <= 50 * n_words as kept from based
"""

OP2 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0b\x0c\r]+') as own
  from documents
), placed as (
  select doc_id, unnest(own) as w, generate_subscripts(own, 1) as i from d where len(own) >= 3
), windows as (
  select doc_id, w || ' ' || lead(w) over p || ' ' || lead(w, 2) over p as gram from placed window p as (partition by doc_id order by i)
), grams as (
  select distinct doc_id, gram from windows where gram is not null
  union all select doc_id, array_to_string(own, ' ') from d where len(own) between 1 and 2
), sizes as (
  select doc_id, count(*) as n from grams group by doc_id
), common_grams as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id group by all
), links as (
  select a, b from common_grams o join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * o.n >= 90 * (x.n + y.n - o.n)
), edges as (
  select a, b from links union all select b, a from links
), reached(doc_id, other) as (
  select doc_id, doc_id from d union select reached.doc_id, edges.b from reached join edges on edges.a = reached.other
)
select d.doc_id, coalesce(sizes.n, 0)::bigint as n_shingles, c.component_id
from d left join sizes using (doc_id) join (select doc_id, min(other) as component_id from reached group by doc_id) c using (doc_id)
"""

OP3 = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), n as (
  select *, max(page_id) over (partition by html) as newest from p
)
select page_id, strlen(html)::bigint as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (k // 4 * 5 + 1)::int, 5))::int >> (15 - 5 * (k % 4))::int) & 31) + 1)::int, 1) for k in range(32)], '') as payload_digest,
  case when page_id is distinct from newest then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from newest then newest end as refers_to
from n
"""

OP7 = r"""
with d as (
  select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\x0c\r]+') as own from documents
), starts as (
  select id, own, unnest(range(1, len(own) - 33)) as i from d where len(own) >= 35
), windows as (
  select id, i, array_to_string(own[i:i + 34], ' ') as words from starts
), repeated as (
  select id, i from windows qualify count(*) over (partition by words) > 1
), gone as (
  select distinct id, unnest(range(i, i + 35)) as i from repeated
), placed as (
  select id, unnest(own) as w, generate_subscripts(own, 1) as i from d
), cut as (
  select p.id, count(g.i) as n_removed, string_agg(w, ' ' order by p.i) filter (where g.i is null) as kept
  from placed p left join gone g on g.id = p.id and g.i = p.i group by p.id
)
select doc_id, len(own)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join cut using (id)
"""

OP9 = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+', ' ', 'g')) as text_sha256 from documents
), n as (
  select doc_id, text_sha256, min(doc_id) over g as keep_id, count(*) over g as group_size,
    row_number() over (partition by text_sha256 order by doc_id nulls last) as place
  from t window g as (partition by text_sha256)
)
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from n
"""

OP11 = r"""
with d as (
  select row_number() over () as id, coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) as piece
  from documents
), own as (
  select row_number() over () as id, lang, regexp_extract_all(piece, '[^ \t]+') as own from d
), placed as (
  select id, lang, unnest(own) as w, generate_subscripts(own, 1) as i from own
), nexts as (
  select lang, w as a, lead(w) over p as b, lead(w, 2) over p as c from placed window p as (partition by id order by i)
), found as (
  select lang, a as phrase, 1 as size, a as first, null as last, count(*) as f from nexts group by all
  union all
  select lang, a || ' ' || b, 2, a, b, count(*) from nexts where b is not null group by all having count(*) >= 10
  union all
  select lang, a || ' ' || b || ' ' || c, 3, a || ' ' || b, b || ' ' || c, count(*) from nexts where c is not null group by all having count(*) >= 10
), keyed as (
  select lang || chr(9) || phrase as key, f from found
), cuts as (
  select lang, phrase, size, f, 1 as k, string_split(phrase, ' ')[1] as l, last as r from found where size > 1
  union all
  select lang, phrase, size, f, 2, first, string_split(phrase, ' ')[3] from found where size = 3
), scored as (
  select c.lang, c.phrase, c.size, c.f as a, c.k, x.f as l, y.f as r,
    ((1000000::hugeint * c.f * c.f) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join keyed x on x.key = c.lang || chr(9) || c.l join keyed y on y.key = c.lang || chr(9) || c.r
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
  select lang, part, max(f) as f from (
    select lang, first as part, f from found where size = 3 union all select lang, last, f from found where size = 3
  ) group by all
), kept as (
  select o.* from lowest o left join longer g on g.lang = o.lang and g.part = o.phrase and o.size = 2
  where g.f is null or 100 * g.f < 50 * o.a
), words as (
  select lang, count(*) as n from placed group by lang
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score from ranked join words using (lang) where rank <= 2000
"""

CHECKS = {
    "op1_quality_rules": OP1,
    "op2_ngram_jaccard": OP2,
    "op3_warc": OP3,
    "op7_substring_dedup": OP7,
    "op9_exact_dedup": OP9,
    "op11_phrases": OP11,
}
