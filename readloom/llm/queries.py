"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries import crc32_sql
from . import jaccard_join, licenses, merge_dropout, packing, pitman_yor, quality_qda, quality_rules, secrets, topk, toxicity
from .store import table


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return merge_dropout.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk(table(spark, sf_dir, "embeddings"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


OP3_SQL = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.r <> c.r
  where q.vec_id % 20 = 0
), k as (
  select query_id, vec_id, score, row_number() over (partition by r order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from k where rank <= 20
"""


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


# ---- what SQL can express of some of them

DECODED_SQL = "select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents"


def merge_dropout_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that come back from the ids of op1."""
    import public_tokenizers

    back = merge_dropout.decode(op1_merge_dropout(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return back.select("doc_id", F.sha2("text", 256).alias("text_sha256"))


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXTS = "d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents)"

RULES_SQL = rf"""
with {_TEXTS}, w as (select r, {_WORDS.format("t")} as ws from d), i as (select r, ws, unnest(range(1, len(ws) - 1)) as i from w),
g as (select r, i, count(*) over (partition by r, ws[i], ws[i + 1], ws[i + 2]) as n from i), c as (select r, count(distinct i + k) as n from g, (select unnest([0, 1, 2]) as k) where n > 1 group by 1),
l as (select r, unnest(string_split(t, chr(10))) as line from d), e as (select r, count(*) - count(distinct line) as n from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
x as (select doc_id, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(e.n, 0) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words
  from d join w using (r) left join c using (r) left join e using (r))
select doc_id, n_words, cast(word_chars as bigint) as word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from x
"""


def rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_quality_rules(spark, sf_dir).select("doc_id", *quality_rules.BASE, "base_failed")


def _places(phrase: str) -> str:
    here = " and ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
    return f"list_filter(range(1, len(ws) + 1), lambda i: {here})"


LICENSE_SQL = rf"""
with {_TEXTS}, w as (select doc_id, regexp_extract_all({_LOWER.format("t")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from d),
p as (select doc_id, ws, {", ".join(f'{_places(p)} as "{label}"' for p, label in licenses.PHRASES.items())} from w), a as (select *, list_concat("gpl", "apache", "cc-by", "mit") as every from p)
select doc_id, len(ws) as n_words, len(every) as n_base, list_min(every) - 1 as first_word, list_max(every) - 1 as last_word, concat_ws(',', {", ".join(f"case when len({chr(34)}{x}{chr(34)}) > 0 then '{x}' end" for x in sorted(licenses.PHRASES.values()))}) as base_labels from a
"""


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


#: Kind, its pattern, and what a match must be.
_SECRETS = (
    ("assign", """((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "length(regexp_extract(m, p, 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
)
SECRET_SQL = f"""
with {_TEXTS}, k as ({" union all ".join(f"select {n} as rank, '{kind}' as kind, '{p}' as p" for n, (kind, p, _) in enumerate(_SECRETS))}),
f as (select r, rank, kind, p, unnest(regexp_extract_all(t, p)) as m, unnest(string_split_regex(t, p)[:-2]) as gap, unnest(range(0, len(regexp_extract_all(t, p)))) as i from d, k),
s as (select *, sum(length(gap) + length(m)) over (partition by r, rank order by i) as stop from f), g as (select r, rank, kind, stop - length(m) as start, stop from s where case rank {" ".join(f"when {n} then {test}" for n, (_, _, test) in enumerate(_SECRETS))} end),
j as (select r, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access, count(*) filter (rank = 2) as n_hex, string_agg(concat(kind, ':', start, ':', stop), ',' order by start, rank) as spans from g group by 1)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256 from d left join j using (r)
"""


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


LANGUAGE_MODEL_SQL = f"""
with {_TEXTS}, t as (select r, doc_id, {crc32_sql("coalesce(cast(doc_id as varchar), '')")} % 7 = 2 as held_out, list_append({_WORDS.format(_LOWER.format("t"))}, chr(10)) as ws from d), w as (select r, held_out, unnest(ws) as w from t),
c as (select w, count(*) as c from w where not held_out group by 1), n as (select cast(sum(c) as bigint) as n, count(*) as v from c),
s as (select r, count(*) as n_tokens, count(c) as n_known, sum(log10(coalesce(c, 0) + 1)) as base from w left join c on c.w = w.w group by 1)
select doc_id, held_out, n_tokens, n_known, n as train_tokens, round(base - n_tokens * log10(n + v + 1), 5) as base_score from t join s using (r), n
"""


def language_model_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op4_pitman_yor(spark, sf_dir)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 5).alias("base_score"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_merge_dropout, op2_toxicity, op3_block_topk, op4_pitman_yor, op5_secrets, op6_quality_rules, op7_quality_qda, op8_packing, op9_licenses, op10_jaccard_join, merge_dropout_decoded, language_model_base, secret_base, rules_base, license_base)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op3_block_topk": OP3_SQL, "merge_dropout_decoded": DECODED_SQL, "language_model_base": LANGUAGE_MODEL_SQL, "secret_base": SECRET_SQL, "rules_base": RULES_SQL, "license_base": LICENSE_SQL}
