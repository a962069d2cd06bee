"""Live acquisition: the newest archive that a listing names, kept under a policy of what may be asked.

A policy holds the limits of a source. The choice of the archive is a query on a table of listings,
the same for one listing or many; only the bytes themselves come through the driver, which the limits
keep small, and land on shared storage, where the executors parse them.
"""
from __future__ import annotations

import re
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contract import ContractError, Source, check_remote, need
from ..storage import Storage, below, shared_folder
from .multirecord import parse_archives

# The limits, the default pattern of archive names, and the error codes below.
MOST_RESPONSE_BYTES = 50_000_000
TIMEOUT_SECONDS = 60
DEFAULT_FILE_NAMES = r"PUBLIC_DISPATCHIS_.*\.zip$"
_HREF = r"(?i)href=[\"']([^\"']+\.zip)[\"']"


class AcquisitionError(RuntimeError):
    pass


class _Refuse(urllib.request.HTTPErrorProcessor):
    """Hands every answer back as it is: a redirect is for the policy to judge, not to follow."""

    def http_response(self, request, response):
        return response

    https_response = http_response


@dataclass(frozen=True)
class FetchPolicy:
    """What may be asked of a source, and how much it may answer."""

    listing: str
    pattern: str = DEFAULT_FILE_NAMES
    most_bytes: int = MOST_RESPONSE_BYTES
    seconds: float = TIMEOUT_SECONDS

    @classmethod
    def of(cls, definition: dict) -> FetchPolicy:
        return cls(check_remote(definition), definition.get("file_name_regex", DEFAULT_FILE_NAMES))

    @property
    def host(self) -> str:
        return urllib.parse.urlsplit(self.listing).hostname

    def admits(self, url: str) -> bool:
        parts = urllib.parse.urlsplit(url)
        return (parts.scheme, parts.hostname) == ("https", self.host)

    def accept(self, status: int, body: bytes) -> bytes:
        """The body of an answer that is within the limits."""
        if 300 <= status < 400:
            raise AcquisitionError("LIVE_SOURCE_REDIRECT_NOT_ALLOWED")
        if status >= 400:
            raise AcquisitionError(f"LIVE_SOURCE_STATUS:{status}")
        if len(body) > self.most_bytes:
            raise AcquisitionError("NEMWEB_RESPONSE_TOO_LARGE")
        return body


Transport = Callable[[str, FetchPolicy], tuple[int, bytes]]


def over_https(url: str, policy: FetchPolicy) -> tuple[int, bytes]:
    """Status and body; of a body that is too long, one byte more than is allowed."""
    opener = urllib.request.build_opener(_Refuse)
    opener.addheaders = [("User-Agent", "voltframe/0.1")]
    with opener.open(url, timeout=policy.seconds) as answer:
        return answer.status, answer.read(policy.most_bytes + 1)


def get(url: str, policy: FetchPolicy, transport: Transport = over_https) -> bytes:
    need(policy.admits(url), "LIVE_SOURCE_HOST_NOT_ALLOWED")
    return policy.accept(*transport(url, policy))


def newest_link(listing: DataFrame, pattern: str, column: str = "html") -> DataFrame:
    """The lexically last link to an archive, as a one-row frame; the same on any table of listings."""
    links = listing.select(F.explode(F.regexp_extract_all(column, F.lit(_HREF), F.lit(1))).alias("href"))
    return links.filter(F.col("href").rlike(f"(?i){pattern}")).agg(F.max("href").alias("href"))


def acquire(spark: SparkSession, definition: dict, landing: str, transport: Transport = over_https) -> tuple[str, str]:
    """Land the newest archive: its URL and where it lies."""
    policy = FetchPolicy.of(definition)
    page = get(policy.listing, policy, transport).decode("latin-1")
    link = newest_link(spark.createDataFrame([(page,)], "html string"), policy.pattern).first()["href"]
    if link is None:
        raise AcquisitionError("NEMWEB_NO_MATCHING_ARCHIVE")
    url = urllib.parse.urljoin(policy.listing, link)
    need(policy.admits(url), "NEMWEB_ARCHIVE_HOST_NOT_ALLOWED")
    target = below(landing, uuid.uuid4().hex, re.sub(r"[^A-Za-z0-9_.-]", "_", url.rpartition("/")[2]))
    Storage(spark).write(target, get(url, policy, transport))
    return url, target


def landing_folder(spark: SparkSession, source: Source) -> str:
    """Where archives land: the definition's folder, or one beside the session's checkpoints, which all executors reach."""
    return source.definition.get("landing_volume_path") or below(shared_folder(spark), "landing")


def read_source(spark: SparkSession, source: Source, transport: Transport = over_https) -> DataFrame:
    """The archive's rows as canonical JSON lines, numbered in the order of their keys."""
    url, target = acquire(spark, source.definition, landing_folder(spark, source), transport)
    rows = parse_archives(spark, target).withColumn("source_file", F.lit(url))
    # one archive is at most 50 MB: numbering it in one task is bounded
    number = F.row_number().over(Window.orderBy("settlement", "region", "intervention"))
    names = sorted(set(rows.columns) - {"settlement", "intervention"})
    line = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    out = rows.select(number.cast("bigint").alias("source_row_number"), line.alias("raw_line"), "source_file")
    if out.isEmpty():
        raise AcquisitionError("NEMWEB_DISPATCHIS_NO_REGION_MARKET_ROWS")
    return out


__all__ = ["AcquisitionError", "ContractError", "FetchPolicy", "acquire", "get", "newest_link", "read_source"]
