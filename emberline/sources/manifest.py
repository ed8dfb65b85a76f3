"""Campaign manifests: a header line and a scene a line, gzipped JSON text."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 1
SCENE = "id string, date string, datetime string, cloud_cover double, mgrs string, epsg int, west double, south double, east double, north double, sun_elevation double, sun_azimuth double, level string, bands map<string,string>"


@dataclass(frozen=True)
class Header:
    source: str
    areas_sha256: str
    start: str
    end: str
    version: int = VERSION

    def check(self, source: str, areas_sha256: str, start: str, end: str) -> None:
        """Refuses a manifest of another source or area file, or of a window that does not cover the asked one."""
        if (self.source, self.areas_sha256) != (source, areas_sha256):
            raise ValueError(f"the manifest is of {self.source} over areas {self.areas_sha256[:8]}, asked for {source} over {areas_sha256[:8]}")
        if self.start > start or self.end < end:
            raise ValueError(f"the manifest covers {self.start} to {self.end}, asked for {start} to {end}")


def digest(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def write_manifest(scenes: DataFrame, header: Header, path: str) -> None:
    """Scenes as JSON lines in parts, the header in a file of its own beside them; the committer renames whole parts."""
    scenes.select(F.to_json(F.struct(*scenes.columns)).alias("value")).write.mode("overwrite").text(f"{path}/scenes", compression="gzip")
    scenes.sparkSession.createDataFrame([(json.dumps(asdict(header), sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header", compression="gzip")


def read_manifest(spark: SparkSession, path: str) -> tuple[Header, DataFrame]:
    """Header and scenes; an unknown version or a bad line is an error, not a gap."""
    raw = json.loads(spark.read.text(f"{path}/header").first()[0])
    if raw.get("version") != VERSION:
        raise ValueError(f"manifest version {raw.get('version')}, not {VERSION}")
    lines = spark.read.text(f"{path}/scenes")
    return Header(**raw), lines.select(F.from_json("value", SCENE, {"mode": "FAILFAST"}).alias("s")).select("s.*")
