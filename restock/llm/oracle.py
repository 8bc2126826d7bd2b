"""The operators' queries as SQL, where SQL can express them."""

ORACLE = {
    "op2_exact_dedup": """
        with named as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as body from documents
        ), met as (
            select body, min(doc_id) as keep_id, count(*) as group_size from named group by body
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(named.body) as text_sha256
        from named join met on named.body = met.body
    """,
    "op7_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
            from embeddings
            where embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
        ), scored as (
            select a.vec_id as query_id, b.vec_id, cast(list_inner_product(cast(a.q as double[]), cast(b.q as double[])) as bigint) as score
            from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
        ), ranked as (
            select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
}
