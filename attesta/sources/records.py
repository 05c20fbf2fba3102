"""Readers and writers of the pipeline's files: typed JSON records, paged responses, review sheets.

Remote services are not called: their cached responses are the input, one file a page.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows after which a paged service is taken to ignore its offset, and tries at a page. Fixed values.
MOST_ROWS, TRIES = 500_000, 4
#: Shapes of the files, as DDL.
SCHEMAS: dict[str, str] = {
    "transcript": "segments array<struct<text string, start double, end double, words array<struct<word string, start double, end double>>>>",
    "diarization": "segments array<struct<speaker string, start double, end double>>",
    "sections": "sections array<struct<section_topic string, start_sec double, end_sec double, start_timestamp string, end_timestamp string, source_notes string, source string>>",
    "metadata": "source_id string, video_id string, youtube_url string, governing_body string, video_title string, published_date string, governing_body_roster array<struct<name string, role string, constituency_group string>>",
    "figures": "page_no int, top_label string, top_conf double, crop_path string, xml string",
    "pictures": "page_no int, bbox array<double>, coord_origin string, area_frac double, top_label string, top_conf double",
    "links": "uri string, page_no int, anchor_text string, context_sentence string, char_start int, char_end int, located boolean",
    "toc": "pages array<int>, entries array<struct<title string, page_ref int, x0 int, page_no int, level int>>",
    "bodies": "BodyId long, BodyName string, BodyTypeName string, BodyActiveFlag int, BodyMeetFlag int",
    "persons": "PersonId long, PersonFullName string, PersonFirstName string, PersonLastName string, PersonActiveFlag int",
    "events": "EventId long, EventBodyId long, EventBodyName string, EventDate string, EventTime string, EventLocation string, EventComment string, EventAgendaFile string, EventMinutesFile string",
    "items": "EventItemId long, EventItemEventId long, EventItemTitle string, EventItemMatterId long, EventItemMoverId long, EventItemSeconderId long, EventItemPassedFlagName string",
    "votes": "VoteId long, VoteEventItemId long, VotePersonId long, VotePersonName string, VoteValueName string",
    "histories": "MatterHistoryId long, MatterHistoryMatterId long, MatterHistoryEventId long, MatterHistoryActionName string, MatterHistoryActionDate string",
    "hyphens": "a string, b string, choice string, resolved string, why string, decided_at string",
}


def read_json(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Records of one kind with their file's name; no schema is inferred. A folder without files is an empty table."""
    schema = T._parse_datatype_string(SCHEMAS[kind])
    return spark.read.schema(schema).option("multiLine", True).option("ignoreMissingFiles", True).json(path).withColumn("file", F.input_file_name())


def words_of(transcripts: DataFrame) -> DataFrame:
    """A row for each word of transcript files, in order; segments without words give one row with the segment's text."""
    segments = transcripts.select("file", F.posexplode("segments").alias("segment", "s"))
    one = F.array(F.struct(F.col("s.text").alias("word"), F.col("s.start").alias("start"), F.col("s.end").alias("end")))
    words = F.when(F.size(F.coalesce("s.words", F.array())) > 0, F.col("s.words")).otherwise(one)
    return segments.select("file", "segment", F.posexplode(words).alias("position", "w")).select("file", "segment", "position", "w.*")


def figures_with_pictures(figures: DataFrame, pictures: DataFrame) -> DataFrame:
    """Figures with the box of the picture that has the same page and label, the largest of several, of equally large ones the first by box; figures without one stay."""
    last = F.struct("area_frac", F.transform("bbox", lambda x: -x))
    boxes = pictures.groupBy("page_no", "top_label").agg(F.max_by(F.struct(F.col("bbox").alias("picture_bbox"), "area_frac"), last).alias("p")).select("page_no", "top_label", "p.*")
    return figures.join(boxes, ["page_no", "top_label"], "left")


class HeaderMismatch(ValueError):
    """A review sheet whose columns aren't exactly the expected ones."""


def read_sheet(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """A review sheet exported as CSV. Any other header stops the import: a shifted column would misfile decisions."""
    found = spark.read.option("header", False).csv(path).limit(1).first()
    got = [c for c in found] if found else []
    if got != list(header):
        raise HeaderMismatch(f"expected {list(header)}, found {got}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.option("header", True).option("multiLine", True).schema(schema).csv(path).withColumn("row_key", F.sha1(F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("")) for c in header])))


def write_sheet(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quoteAll", True).mode("errorifexists").csv(path)


class Page(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


class PagedReader(DataSourceReader):
    """A partition for each cached page.

    A page shorter than the page size is the last; a page beyond it is not read even if it is cached. Without
    a number of pages they are counted until one is missing, empty or short. A service that never ends is
    stopped at MOST_ROWS.
    """

    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.options = schema, options
        self.size = int(options.get("pageSize", "1000"))

    def _path(self, number: int) -> str:
        skip = number * self.size
        path = self.options["path"].removeprefix("file://")
        # a cache names each page by a digest of its request, as the order of its parts is fixed
        return path.format(skip=skip, digest=page_key(self.options.get("request", ""), self.size, skip))

    def _rows(self, number: int) -> list[dict] | None:
        for attempt in range(TRIES):
            try:
                with open(self._path(number), encoding="utf-8") as f:
                    return json.load(f)
            except FileNotFoundError:
                return None
            except (OSError, ValueError):  # a page that is being written, or a share that is away for a moment
                if attempt == TRIES - 1:
                    raise
                time.sleep(0.1 * 2**attempt)
        return None

    def partitions(self) -> Sequence[InputPartition]:
        known, found = self.options.get("pages"), []
        while known is None or len(found) < int(known):
            if len(found) * self.size >= MOST_ROWS:
                raise ValueError(f"over {MOST_ROWS} rows: the service ignores the offset")
            rows = self._rows(len(found))
            if rows is None and known is not None:
                raise FileNotFoundError(self._path(len(found)))
            if not rows:
                break
            found.append(Page(len(found)))
            if len(rows) < self.size:
                break
        return found or [Page(-1)]

    def read(self, partition: Page) -> Iterator[tuple]:
        for row in (self._rows(partition.number) or []) if partition.number >= 0 else []:
            yield tuple(row.get(c) for c in self.schema.fieldNames())


def page_key(request: str, size: int, skip: int) -> str:
    """The digest under which a page of a request is cached."""
    return hashlib.sha1(f"{request}&$top={size}&$skip={skip}".encode()).hexdigest()


class PagedSource(DataSource):
    """``spark.read.format("paged_json")``: pages of a paged service, cached in a folder that all executors see.

    Options: path with ``{skip}`` or ``{digest}`` (of ``request``, page size and offset), pages, pageSize. The schema is required.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(schema, self.options)


def accessor(spark: SparkSession, kind: str, path: str, **options: str) -> DataFrame:
    """Cached pages of one kind of a service's records, typed: bodies, persons, events, items, votes or histories."""
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_json").schema(SCHEMAS[kind]).options(**options).load(path)


def votes(items: DataFrame) -> DataFrame:
    """Votes with a value; blank ones were never cast."""
    return items.where(F.col("VoteValueName").isNotNull())


def since(events: DataFrame, body: str | None, start: str | None) -> DataFrame:
    """Events of a body from a date on; a condition that is None is left out."""
    if body is not None:
        events = events.where(F.col("EventBodyName") == body)
    if start is not None:
        events = events.where(F.to_date("EventDate") >= F.lit(start).cast("date"))
    return events


def registry_aliases(registry: DataFrame) -> DataFrame:
    """(canonical, alias) of a registry of canonical, aliases, ambiguous: aliases that name several things are left out."""
    pairs = registry.select("canonical", F.explode(F.concat(F.array("canonical"), F.coalesce("aliases", F.array()))).alias("alias"), F.coalesce("ambiguous", F.array()).alias("ambiguous"))
    clear = pairs.where(~F.array_contains("ambiguous", F.col("alias"))).select("canonical", F.lower(F.trim("alias")).alias("alias")).distinct()
    named = clear.groupBy("alias").agg(F.count("*").alias("n"), F.min("canonical").alias("canonical"))
    return named.where("n = 1").select("canonical", "alias")
