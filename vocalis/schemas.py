"""Declared schemas: landed pages and stage tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STRINGS = T.ArrayType(T.StringType(), True)

SEARCH_PAGE = _struct(
    page_no=T.IntegerType(),
    nextPageToken=T.StringType(),
    items=T.ArrayType(_struct(id=_struct(videoId=T.StringType()))),
)

DETAIL_PAGE = _struct(
    page_no=T.IntegerType(),
    items=T.ArrayType(
        _struct(
            id=T.StringType(),
            snippet=_struct(title=T.StringType(), publishedAt=T.StringType()),
            statistics=_struct(viewCount=T.StringType(), commentCount=T.StringType()),
            contentDetails=_struct(duration=T.StringType()),
        )
    ),
)

COMMENT_PAGE = _struct(
    video_id=T.StringType(),
    page_no=T.IntegerType(),
    nextPageToken=T.StringType(),
    items=T.ArrayType(
        _struct(
            snippet=_struct(
                topLevelComment=_struct(
                    snippet=_struct(
                        textDisplay=T.StringType(),
                        likeCount=T.StringType(),
                        authorDisplayName=T.StringType(),
                    )
                )
            )
        )
    ),
)

LISTING = _struct(subreddit=T.StringType(), title=T.StringType())

RAW_HEADLINES = _struct(headline=T.StringType())
RAW_COMMENTS = _struct(video_id=T.StringType(), video_title=T.StringType(), comment=T.StringType())
CLEAN = _struct(text=T.StringType(), cleaned=T.StringType())
TAGGED = T.StructType(CLEAN.fields + _struct(phone_models=STRINGS, topics=STRINGS).fields)
LABELLED = T.StructType(TAGGED.fields + _struct(sentiment=T.StringType()).fields)
STORE = T.StructType(LABELLED.fields + _struct(source=T.StringType(), batch=T.StringType()).fields)
