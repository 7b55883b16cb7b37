"""Combined retrieval and the flattening of nested answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filelake import constants as C
from filelake import schemas
from filelake.operators import text, vectors
from filelake.operators.index import IndexJob
from filelake.session import stage


def combined(queries: DataFrame, images: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per query: ``query_id, query, image_matches, document_matches``.

    ``images`` is ``(query_id, rank, datapoint_id, distance)`` and ``documents`` is
    ``(query_id, rank, doc_id, title, link, snippet)``, each one page per query. The two lists stay
    independent, in rank order, and are empty where nothing was found.
    """
    image = F.struct(
        "rank", F.struct(F.col("datapoint_id").cast("string").alias("file_id"), "distance").alias("m")
    )
    document = F.struct("rank", F.struct(
        F.col("doc_id").cast("string").alias("document_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("link", F.lit("")).alias("link"),
        F.coalesce("snippet", F.lit("")).alias("snippet"),
    ).alias("m"))

    def listed(rows: DataFrame, cell: Column, name: str) -> DataFrame:
        ordered = F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["m"])
        return rows.groupBy("query_id").agg(ordered.alias(name))

    return (
        queries.select("query_id", F.col("text").alias("query"))
        .join(listed(images, image, "image_matches"), "query_id", "left")
        .join(listed(documents, document, "document_matches"), "query_id", "left")
        .select(
            "query_id", "query",
            F.coalesce("image_matches", F.array()).alias("image_matches"),
            F.coalesce("document_matches", F.array()).alias("document_matches"),
        )
    )


def document_page(queries: DataFrame, docs: DataFrame, index: IndexJob | None = None) -> DataFrame:
    """Best documents of every query with score, rank, title, link and snippet.

    ``docs`` is ``(doc_id, text, title, link)``. With a stored ``index`` of them only the texts of the hits
    are read.
    """
    terms = stage(text.query_terms(queries), "query-terms")
    page = index.page(queries, terms) if index else text.page(queries, docs, terms)
    return text.snippets(page, terms, docs)


def search(
    queries: DataFrame, docs: DataFrame, datapoints: DataFrame, dim: int, index: IndexJob | None = None
) -> DataFrame:
    """Nearest images and best documents of ``(query_id, text, k)``, one row per query.

    Query texts are encoded into the space of the datapoints; see ``vectors.text_vectors``.
    """
    asked = vectors.text_vectors(queries, "query_id", "text", dim)
    return combined(queries, vectors.topk(asked, datapoints, dim), document_page(queries, docs, index))


def as_json(results: DataFrame) -> DataFrame:
    """The combined result as one JSON document per query."""
    body = F.to_json(F.struct("query", "image_matches", "document_matches"))
    return results.select("query_id", body.alias("body"))


def flatten_neighbors(responses: DataFrame) -> DataFrame:
    """Neighbours in ``(query_id, body)``: the first answer's list, one row each, with its position.

    A missing id is the empty string and a missing distance 0; missing or empty lists give no row.
    """
    body = F.from_json("body", schemas.NEIGHBOR_RESPONSE)
    first = F.try_element_at(body["nearestNeighbors"], F.lit(1))["neighbors"]
    rows = responses.select("query_id", F.posexplode(first).alias("pos", "n"))
    return rows.select(
        "query_id",
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        F.coalesce("n.datapoint.datapointId", F.lit("")).alias("file_id"),
        F.coalesce("n.distance", F.lit(0.0)).alias("distance"),
    )


def flatten_results(responses: DataFrame, title_from_id: bool = False) -> DataFrame:
    """Documents in ``(query_id, body)`` with the defaults of the combined list.

    ``title_from_id`` gives the document list's own default: the id where there is no title.
    """
    body = F.from_json("body", schemas.SEARCH_RESPONSE)
    rows = responses.withColumn("b", body).select(
        "query_id", F.coalesce("b.totalSize", F.lit(0)).alias("total_size"),
        F.posexplode("b.results").alias("pos", "r"),
    )
    doc_id = F.coalesce("r.document.id", F.lit(""))
    derived = F.col("r.document.derivedStructData")
    snippet = F.try_element_at(derived["snippets"], F.lit(1))["snippet"]
    return rows.select(
        "query_id",
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        doc_id.alias("document_id"),
        F.coalesce(derived["title"], doc_id if title_from_id else F.lit("")).alias("title"),
        F.coalesce(derived["link"], F.lit("")).alias("link"),
        F.coalesce(snippet, F.lit("")).alias("snippet"),
        "total_size",
    )


def shown_distance(distance: Column) -> Column:
    return F.round(distance, 4)


def shown_snippet(snippet: Column) -> Column:
    return F.substring(snippet, 1, C.SNIPPET_CHARS)
