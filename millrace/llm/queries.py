"""One query per operator over the given tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import encode_texts, read_ranks
from millrace.llm.centroids import cluster_vectors
from millrace.llm.embeddings import link_vectors
from millrace.llm.language import predict_language, train_language_model
from millrace.llm.lines import drop_frequent_lines
from millrace.llm.minhash import link_documents
from millrace.llm.mixing import mix_sources
from millrace.llm.neighbours import nearest_vectors
from millrace.llm.quality_model import score_quality, train_quality_model, word_vectors
from millrace.llm.quality_rules import judge_quality
from millrace.llm.substrings import remove_repeated_windows
from millrace.llm.suffixes import remove_earlier_strings
from millrace.llm.whitening import whiten_vectors
from millrace.staging import Staging

_SPACE = r"\x20\x09-\x0D"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _fold(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def op1_embedding_near_dedup(spark, sf_dir) -> DataFrame:
    return link_vectors(_embeddings(spark, sf_dir), Staging(spark), threshold=0.95)


def op2_substring_dedup(spark, sf_dir) -> DataFrame:
    out = remove_repeated_windows(_documents(spark, sf_dir), Staging(spark), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_quality_classifier(spark, sf_dir) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = _fold(5) == 0
    vectors = word_vectors(docs)
    net = train_quality_model(docs, labels, vectors, ~held_out, label="quality", sample=20_000)
    return score_quality(docs, vectors, net).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_line_dedup(spark, sf_dir) -> DataFrame:
    out = drop_frequent_lines(_documents(spark, sf_dir), Staging(spark), least_chars=40, copies=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_byte_bpe(spark, sf_dir) -> DataFrame:
    tokens = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = encode_texts(_documents(spark, sf_dir), tokens, public_tokenizers.PATTERN, decode=True)
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_quality_rules(spark, sf_dir) -> DataFrame:
    out = judge_quality(_documents(spark, sf_dir), Staging(spark))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return out.select(*base, "kept", "posterior")


def op7_source_mixing(spark, sf_dir) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir), Staging(spark), power=0.5)


def op8_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    return link_documents(_documents(spark, sf_dir), Staging(spark), shingle=2, percent=80)


def op9_language_id(spark, sf_dir) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = _fold(4) == 2
    model = train_language_model(docs, ~held_out, window=128, per_language=1500)
    return predict_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_suffix_array_dedup(spark, sf_dir) -> DataFrame:
    out = remove_earlier_strings(_documents(spark, sf_dir), Staging(spark), window=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


def op11_centroid_clustering(spark, sf_dir) -> DataFrame:
    return cluster_vectors(_embeddings(spark, sf_dir), Staging(spark), dims=64, scale=64, clusters=16, rounds=3)


def op12_nearest_neighbours(spark, sf_dir) -> DataFrame:
    every_twentieth = F.col("vec_id") % 20 == 0
    return nearest_vectors(_embeddings(spark, sf_dir), Staging(spark), every_twentieth, most=20)


def op13_embedding_whitening(spark, sf_dir) -> DataFrame:
    out = whiten_vectors(_embeddings(spark, sf_dir), Staging(spark), scale=256, most=4)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_near_dedup": op1_embedding_near_dedup,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_line_dedup": op4_line_dedup,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_quality_rules": op6_quality_rules,
        "op7_source_mixing": op7_source_mixing,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_language_id": op9_language_id,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_nearest_neighbours": op12_nearest_neighbours,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


# Groups that links connect: every node with the nodes it reaches.
_REACH = """reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)"""


def _clustered(rounds: int) -> str:
    """The vectors ``v``, and centroids ``c<i>`` and nearest clusters ``a<i>`` after ``i`` rounds."""
    parts = [
        """v as (select row_number() over () as r, vec_id, list_transform(embedding,
            lambda x: cast(floor(64 * cast(x as double)) as bigint)) as x from embeddings
            where len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))))""",
        """c0 as (select cast(row_number() over (order by sha256('1:' || vec_id), x) - 1 as integer) as c, x as m from v
            qualify c < 16)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as (select r, vec_id, x, c, d from (select r, vec_id, x, c, cast(list_sum(list_transform(
            range(1, 65), lambda j: (x[j] - m[j]) * (x[j] - m[j]))) as bigint) as d from v, c{i})
            qualify row_number() over (partition by r order by d, c) = 1)""")
        parts.append(f"""c{i + 1} as (select c, coalesce(f, m) as m from c{i} left join (select c, list(f order by j) as f
            from (select c, j, cast(floor_of(sum(y), count(*)) as bigint) as f
                from (select c, unnest(x) as y, unnest(range(1, 65)) as j from a{i}) group by c, j) group by c) using (c))""")
    return ", ".join(parts[:-1]).replace("floor_of(sum(y), count(*))", "(sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*)")


def oracle_sql() -> dict[str, str]:
    return {
        "op11_centroid_clustering": f"""
            with {_clustered(3)}
            select vec_id, c as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
                cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(m, ',')) as centroid_sha256
            from a3 join c3 using (c)""",
        "op1_embedding_near_dedup": f"""
            with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings
                    where embedding is not null and list_bool_and(list_transform(embedding,
                        lambda x: x is not null and isfinite(x)))
                    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
                links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id
                    and len(x.e) = len(y.e) where list_cosine_similarity(x.e, y.e) >= 0.95),
                {_REACH},
                n as (select a, count(*) as n from links group by a),
                c as (select a, min(least(a, b)) as c from reach group by a)
            select vec_id, coalesce(n, 0) as n_links, coalesce(c, vec_id) as component_id,
                coalesce(c, vec_id) = vec_id as kept
            from embeddings left join n on n.a = vec_id left join c on c.a = vec_id""",
        "op7_source_mixing": """
            with recursive n as (select source, cast(greatest(1, floor(sqrt(count(*)))) as bigint) as w
                    from documents group by source),
                g as (select list_reduce(list(w), lambda x, y: gcd(x, y)) as g from n),
                q as (select source, row_number() over (order by source nulls last) as i, cast(w // g as bigint) as k from n, g),
                p as (select list(k order by i) as k, cast(sum(k) as bigint) as n, list(cast(0 as bigint) order by i) as none from q),
                due as (select cast(0 as bigint) as t, cast(null as bigint) as i, none as b from p
                    union all select t + 1, pick, list_transform(b, lambda x, j: x + if(j = pick, 1, 0)) from (
                        select t, b, list_sort(list_transform(list_filter(range(1, len(k) + 1),
                            lambda j: b[j] < k[j] and b[j] * n // k[j] <= t),
                            lambda j: {'d': ((b[j] + 1) * n + k[j] - 1) // k[j], 'j': j}))[1].j as pick
                        from due, p where t < n)),
                slots as (select i, t - 1 as slot, b[i] - 1 as turn from due where t > 0),
                r as (select doc_id, source, row_number() over (partition by source
                    order by md5(coalesce(cast(doc_id as varchar), '')), doc_id) - 1 as r from documents)
            select doc_id, r.source, r // 16 as mix_block, r // 16 // q.k * p.n + slot as mix_slot, r % 16 as mix_place
            from r join q on r.source is not distinct from q.source
                join slots on slots.i = q.i and slots.turn = r // 16 % q.k, p""",
        "op8_minhash_near_dedup": f"""
            with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_SPACE}]+') as w from documents),
                s as (select distinct doc_id, unnest(case when len(w) >= 2
                    then list_transform(range(1, len(w)), lambda i: md5(w[i] || ' ' || w[i + 1]))
                    when len(w) = 1 then [md5(w[1])] else [] end) as s from d),
                n as (select doc_id, count(*) as n from s group by doc_id),
                shared as (select x.doc_id as a, y.doc_id as b, count(*) as n from s x join s y on x.s = y.s
                    and x.doc_id <> y.doc_id group by all),
                links as (select a, b from shared z join n x on x.doc_id = a join n y on y.doc_id = b
                    where 100 * z.n >= 80 * (x.n + y.n - z.n)),
                {_REACH},
                c as (select a, min(least(a, b)) as c from reach group by a)
            select doc_id, coalesce(n, 0) as n_shingles, coalesce(c, doc_id) as component_id,
                coalesce(c, doc_id) = doc_id as kept
            from documents left join n using (doc_id) left join c on c.a = doc_id""",
        "op2_substring_dedup": f"""
            with d as (select row_number() over () as r, doc_id,
                    regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') as w from documents),
                windows as (select r, unnest(range(1, len(w) - 33)) as i, w from d where len(w) >= 35),
                hashed as (select r, i, sha256(array_to_string(w[i : i + 34], ' ')) as h from windows),
                again as (select r, i from hashed
                    where h in (select h from hashed group by h having count(*) > 1)),
                gone as (select r, i from (select distinct r, unnest(range(i, i + 35)) as i from again)),
                words as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
                kept as (select r, string_agg(word, ' ' order by i) as text, count(*) as n
                    from words anti join gone using (r, i) group by r)
            select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
                sha256(coalesce(kept.text, '')) as kept_sha256 from d left join kept using (r)""",
        "op4_line_dedup": f"""
            with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
                lines as (select doc_id, unnest(l) as line, unnest(range(len(l))) as i from d),
                keyed as (select *, translate(regexp_replace(line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
                often as (select key, max(doc_id) as last from keyed where length(key) >= 40
                    group by key having count(distinct doc_id) >= 5)
            select doc_id, count(*) as n_lines,
                count(*) filter (last is not null and doc_id <> last) as n_dropped,
                sha256(coalesce(string_agg(line, chr(10) order by i)
                    filter (last is null or doc_id = last), '')) as kept_sha256
            from keyed left join often using (key) group by doc_id""",
    }
