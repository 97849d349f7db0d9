"""Table layouts."""

from pyspark.sql import types as T

CODE_SAMPLES = T.StructType(
    [
        T.StructField("original_index", T.LongType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("lang", T.StringType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("repo_full_name", T.StringType()),
        T.StructField("star", T.LongType()),
        T.StructField("len_tokens", T.LongType()),
        T.StructField("dir", T.StringType()),
        T.StructField("created_date", T.DateType()),
        T.StructField("updated_date", T.DateType()),
    ]
)

CODE_DOCS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("stars", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("original_index", T.LongType()),
        T.StructField("chunk_id", T.StringType()),
        T.StructField("code_hash", T.StringType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("doc_hash", T.StringType()),
        T.StructField("summary_ok", T.BooleanType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

QUERY_LOG = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("final_answer", T.StringType()),
        T.StructField("retrieved_doc_ids", T.ArrayType(T.StringType())),
        T.StructField("final_doc_ids", T.ArrayType(T.StringType())),
    ]
)

BLOBS = T.StructType([T.StructField("key", T.StringType()), T.StructField("body", T.StringType())])
