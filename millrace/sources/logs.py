"""Application log: one JSON document per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOG_SCHEMA = """
common struct<ar:string,ba:string,ch:string,is_new:string,md:string,mid:string,os:string,uid:string,vc:string,sid:string>,
page struct<item:string,item_type:string,last_page_id:string,page_id:string,from_pos_id:string,from_pos_seq:string,refer_id:string,during_time:bigint>,
start struct<entry:string,open_ad_id:string,loading_time:bigint>,
err struct<error_code:string,msg:string>,
displays array<struct<display_type:string,item:string,item_type:string,pos_id:string,pos_seq:string>>,
actions array<struct<action_id:string,item:string,item_type:string,ts:bigint>>,
ts bigint
""".replace("\n", "")

# output column -> path in the parsed document
PAGE_FIELDS = {
    "province_id": "common.ar", "brand": "common.ba", "channel": "common.ch",
    "is_new": "common.is_new", "model": "common.md", "mid_id": "common.mid",
    "operate_system": "common.os", "user_id": "common.uid", "version_code": "common.vc",
    "page_item": "page.item", "page_item_type": "page.item_type",
    "last_page_id": "page.last_page_id", "page_id": "page.page_id",
    "from_pos_id": "page.from_pos_id", "from_pos_seq": "page.from_pos_seq",
    "refer_id": "page.refer_id", "session_id": "common.sid", "during_time": "page.during_time",
}


def _parsed(text: Column) -> Column:
    return F.from_json(text, LOG_SCHEMA + ", _corrupt string",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


def decode(df: DataFrame, column: str = "log") -> DataFrame:
    """Parse once; ``doc`` is the document, ``dirty`` marks text that is not a JSON object.

    The one-element explode keeps later filters and field picks above the parser, so each text is
    parsed a single time instead of once per filter and field.
    """
    doc = df.withColumn("doc", F.explode(F.array(_parsed(F.col(column)))))
    return doc.withColumn("dirty", F.col("doc").isNull() | F.col("doc._corrupt").isNotNull())


def split_dirty(df: DataFrame, column: str = "log") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, dirty text)."""
    both = decode(df, column)
    good = both.where(~F.col("dirty")).select("doc.*").drop("_corrupt")
    bad = both.where(F.col("dirty")).select(F.col(column).alias("dirty_text"))
    return good, bad


def decode_clean(df: DataFrame, column: str = "log") -> DataFrame:
    """Drop null, blank and unparsable text."""
    kept = df.where(F.col(column).isNotNull() & (F.trim(F.col(column)) != ""))
    return split_dirty(kept, column)[0]


def page_fields(docs: DataFrame) -> DataFrame:
    """Flat page-view columns of the documents that carry a page part."""
    return docs.where(F.col("page").isNotNull()).select(
        *[F.col(path).alias(name) for name, path in PAGE_FIELDS.items()], F.col("ts")
    )


def to_documents(flat: DataFrame, errors: bool = False) -> DataFrame:
    """Inverse of the decoder for a flat page log: one JSON text column ``log``."""
    common = F.struct(*[F.col(c) for c in ("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc", "sid")])
    page = F.struct(*[F.col(c) for c in ("item", "item_type", "last_page_id", "page_id", "during_time")])
    parts = [common.alias("common"), page.alias("page")]
    if errors:
        parts.append(F.when(F.col("is_error") == 1, F.struct(
            F.lit("1001").alias("error_code"), F.col("page_id").alias("msg"))).alias("err"))
        parts.append(F.when(F.col("shows") > 0, F.transform(
            F.sequence(F.lit(1), F.greatest(F.col("shows"), F.lit(1))),
            lambda i: F.struct(F.lit("promotion").alias("display_type"), i.cast("string").alias("item"),
                               F.lit("sku_id").alias("item_type"), i.cast("string").alias("pos_id"),
                               i.cast("string").alias("pos_seq")))).alias("displays"))
        parts.append(F.when(F.col("acts") > 0, F.array(F.struct(
            F.lit("cart_add").alias("action_id"), F.col("item").alias("item"),
            F.lit("sku_id").alias("item_type"), F.col("ts_ms").alias("ts")))).alias("actions"))
    text = F.to_json(F.struct(*parts, F.col("ts_ms").alias("ts")))
    # one-element explode: filters on the text do not build it again
    return flat.select(F.explode(F.array(text)).alias("log"))


def route(docs: DataFrame) -> DataFrame:
    """Record router: each document becomes one row per channel it feeds.

    ``err`` for the error part; ``start`` for start logs; for the others one row per display,
    one per action and one page row. Channels and payload come out of a single pass.
    """
    def row(channel: str, payload: Column) -> Column:
        return F.struct(F.lit(channel).alias("channel"), F.to_json(payload).alias("payload"))

    page_log = F.col("start").isNull()
    err = F.when(F.col("err").isNotNull(), F.array(row("err", F.col("err"))))
    start = F.when(F.col("start").isNotNull(),
                   F.array(row("start", F.struct("common", "start", "ts"))))
    displays = F.when(page_log, F.transform("displays", lambda d: row(
        "display", F.struct(F.col("common").alias("common"), F.col("page").alias("page"),
                            d.alias("display"), F.col("ts").alias("ts")))))
    actions = F.when(page_log, F.transform("actions", lambda a: row(
        "action", F.struct(F.col("common").alias("common"), F.col("page").alias("page"), a.alias("action")))))
    page = F.when(page_log, F.array(row("page", F.struct("common", "page", "ts"))))
    empty = F.expr("cast(array() as array<struct<channel:string,payload:string>>)")
    parts = [F.coalesce(p, empty) for p in (err, start, displays, actions, page)]
    return docs.select(F.col("common.mid").alias("mid"), F.col("ts"),
                       F.explode(F.concat(*parts)).alias("r")).select("mid", "ts", "r.channel", "r.payload")
