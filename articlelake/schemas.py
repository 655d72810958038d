"""Record shapes shared by sources, jobs and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

_vector = T.MapType(T.StringType(), T.FloatType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


INDICATORS = T.ArrayType(
    _struct(name=T.StringType(), values=T.ArrayType(T.StringType()))
)
TAGS = _struct(automatic=T.ArrayType(T.StringType()), interesting=INDICATORS)
ML = _struct(labels=T.ArrayType(T.StringType()), incident=T.IntegerType())
CHUNKS = T.ArrayType(_struct(text=T.StringType(), elser=_vector))
EMBEDDINGS = _struct(
    title=_struct(elser=_vector),
    description=_struct(elser=_vector),
    content_chunks=CHUNKS,
)

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("image_url", T.StringType()),
        T.StructField("profile", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("publish_date", T.TimestampType()),
        T.StructField("inserted_at", T.TimestampType()),
        T.StructField("content", T.StringType()),
        T.StructField("formatted_content", T.StringType()),
        T.StructField("tags", TAGS),
        T.StructField("ml", ML),
        T.StructField("summary", T.StringType()),
        T.StructField("read_times", T.LongType()),
        T.StructField("embeddings", EMBEDDINGS),
    ]
)

_selector = _struct(element=T.StringType(), content_field=T.StringType())

PROFILE_SCHEMA = _struct(
    source=_struct(
        profile_name=T.StringType(),
        name=T.StringType(),
        address=T.StringType(),
        retrieval_method=T.StringType(),
        news_paths=T.ArrayType(T.StringType()),
        scraping_targets=_struct(
            container_list=T.StringType(),
            link_containers=T.StringType(),
            links=T.StringType(),
        ),
    ),
    scraping=_struct(
        js_injections=T.ArrayType(T.StringType()),
        meta=_struct(
            title=_selector,
            description=_selector,
            image_url=_selector,
            author=_selector,
            publish_date=_selector,
        ),
        content=_struct(container=T.StringType(), remove=T.ArrayType(T.StringType())),
    ),
    enabled=T.BooleanType(),
)

PAGE_SCHEMA = _struct(
    page_id=T.LongType(),
    url=T.StringType(),
    html=T.StringType(),
    status=T.IntegerType(),
)

#: Fields carried over between two indices by `copy_fields`.
COPIED_FIELDS = ["ml", "tags", "summary", "read_times"]
