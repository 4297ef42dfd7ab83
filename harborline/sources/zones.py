"""Named latitude/longitude rectangles (zones) and their two file forms.

JSON form: a list of {"chokepoints": name, "bbox": [[lat1, lon1], [lat2, lon2]]},
south-west corner first. CSV form: `minlon,minlat,maxlon,maxlat, name` with an
optional free comment after ` -> ` (or ` - >`). Both readers give the same
columns: name, lat1, lon1, lat2, lon2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE_SCHEMA = "name string, lat1 double, lon1 double, lat2 double, lon2 double"

# The 28 shipped zones, in file order,
# as (name, SW latitude, SW longitude, NE latitude, NE longitude).
SHIPPED_ZONES = [
    ("Suez Canal", 30.0933, 31.9369, 31.0933, 32.9369),
    ("Panama Canal", 8.90949, -79.97498, 9.43281, -79.45587),
    ("Bosporus Strait", 40.98508, 28.95721, 41.23961, 29.16733),
    ("Bab el-Mandeb Strait", 12.4473, 43.20374, 12.86536, 43.6322),
    ("Malacca Strait", 2.74553, 99.00879, 5.02528, 101.90918),
    ("Strait of Hormuz", 25.7969, 56.3598, 26.7969, 57.3598),
    ("Cape of Good Hope", -35.90685, 17.66602, -33.44978, 27.00439),
    ("Gibraltar Strait", 35.65283, -5.92712, 36.19553, -5.32837),
    ("Dover Strait", 50.82676, 1.27441, 51.17934, 1.66992),
    ("Oresund Strait", 55.60318, 12.50244, 56.0078, 13.1012),
    ("Taiwan Strait", 23.09994, 116.71875, 27.37177, 121.37695),
    ("Korea Strait", 33.25706, 128.37524, 35.24562, 130.61646),
    ("Tsugaru Strait", 41.17038, 140.18005, 41.81636, 140.89417),
    ("Luzon Strait", 19.9889, 120.8523, 20.9889, 121.8523),
    ("Lombok Strait", -8.51584, 115.60913, -8.32021, 116.10901),
    ("Ombai Strait", -8.62447, 125.08484, -8.27401, 125.56274),
    ("Bohai Strait", 37.77506, 120.56946, 38.78835, 121.20667),
    ("Torres Strait", -10.96816, 142.21802, -9.19429, 142.66846),
    ("Sunda Strait", -6.07228, 105.72693, -5.83462, 105.96039),
    ("Makassar Strait", 0.0769, 118.78418, 1.02167, 119.90479),
    ("Magellan Strait", -52.53296, -69.63135, -52.44598, -69.5105),
    ("Yucatan Channel", 21.08963, -86.92383, 22.41103, -83.93555),
    ("Windward Passage", 19.68397, -74.1975, 20.2725, -73.31177),
    ("Mona Passage", 18.0832, -68.44482, 18.65665, -67.00562),
    ("Balabac Strait", 6.92643, 116.69128, 8.3963, 117.30103),
    ("Bering Strait", 65.52207, -169.99707, 66.16051, -167.76123),
    ("Mindoro Strait", 12.09304, 120.17944, 12.80109, 120.91553),
    ("Kerch Strait", 45.08904, 36.38123, 45.47939, 36.8866),
]

# The single zone used when no zone file can be read (Hormuz).
DEFAULT_ZONE = ("Strait of Hormuz", 25.7969, 56.3598, 26.7969, 57.3598)


def zones_frame(spark: SparkSession, zones=None) -> DataFrame:
    """Zones given in code: tuples (name, lat1, lon1, lat2, lon2) or corner
    pairs [[lat1, lon1], [lat2, lon2]] (then the name is null)."""
    rows = []
    for z in (SHIPPED_ZONES if zones is None else zones):
        if len(z) == 2:
            (a, b), (c, d) = z
            rows.append((None, float(a), float(b), float(c), float(d)))
        else:
            rows.append((z[0], float(z[1]), float(z[2]), float(z[3]), float(z[4])))
    return spark.createDataFrame(rows, ZONE_SCHEMA)


def read_zones_json(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("chokepoints string, bbox array<array<double>>") \
        .option("multiLine", True).json(path)
    b = F.col("bbox")
    return raw.select(F.col("chokepoints").alias("name"),
                      b[0][0].alias("lat1"), b[0][1].alias("lon1"),
                      b[1][0].alias("lat2"), b[1][1].alias("lon2"))


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.col("value"), ",", 5)
    name = F.trim(F.regexp_replace(parts[4], r"\s*-\s*>.*$", ""))
    return (spark.read.text(path)
            .where(F.trim("value") != "")
            .select(name.alias("name"),
                    F.trim(parts[1]).cast("double").alias("lat1"),
                    F.trim(parts[0]).cast("double").alias("lon1"),
                    F.trim(parts[3]).cast("double").alias("lat2"),
                    F.trim(parts[2]).cast("double").alias("lon2")))


def load_zones(spark: SparkSession, zones=None, path: str | None = None) -> DataFrame:
    """Zones to watch: an explicit non-empty list wins; else the JSON file;
    a missing or unreadable file gives the one default zone."""
    if zones:
        return zones_frame(spark, zones)
    if path:
        try:
            df = read_zones_json(spark, path).dropna(
                subset=["lat1", "lon1", "lat2", "lon2"])
            if not df.isEmpty():
                return df
        except Exception:  # unreadable file -> default zone, as documented
            pass
    return zones_frame(spark, [DEFAULT_ZONE])
