"""mzML spectra as a Spark data source: spark.read.format("mzml").load(path).

Option ms_level=1 (or 2) leaves the other spectra out before their peaks are decoded; peaks=false leaves all peaks out.
One task reads one file.
"""

from __future__ import annotations

import base64
import glob
import os
import re
import xml.etree.ElementTree as ElementTree
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

SCHEMA = "file string, ord long, scan int, ms_level int, rt double, mz array<double>, intensity array<double>, precursor_mz double, ms1_scan int"
#: Accessions of the controlled vocabulary.
MS_LEVEL, RT, ZLIB, DOUBLE, FLOAT, MZ_ARRAY, INTENSITY_ARRAY, SELECTED_MZ, MINUTE = "MS:1000511", "MS:1000016", "MS:1000574", "MS:1000523", "MS:1000521", "MS:1000514", "MS:1000515", "MS:1000744", "UO:0000031"


def _name(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _terms(element: ElementTree.Element) -> dict[str, ElementTree.Element]:
    return {e.get("accession", ""): e for e in element.iter() if _name(e) == "cvParam"}


def _array(element: ElementTree.Element) -> tuple[str, np.ndarray]:
    terms = _terms(element)
    text = next((e.text or "" for e in element if _name(e) == "binary"), "")
    data = base64.b64decode(text)
    if ZLIB in terms:
        data = zlib.decompress(data)
    values = np.frombuffer(data, "<f4" if FLOAT in terms else "<f8").astype(np.float64)
    return ("mz" if MZ_ARRAY in terms else "intensity" if INTENSITY_ARRAY in terms else ""), values


def spectra(path: str, ms_level: int | None = None, peaks: bool = True) -> Iterator[tuple]:
    """The spectra of a file in order; times in minutes; MS2 spectra name the MS1 spectrum before them."""
    last_ms1, order = None, 0
    for _, element in ElementTree.iterparse(path, ("end",)):
        if _name(element) != "spectrum":
            continue
        terms = _terms(element)
        level = int(terms[MS_LEVEL].get("value", "0")) if MS_LEVEL in terms else 0
        found = re.search(r"scan=(\d+)", element.get("id", ""))
        scan = int(found.group(1)) if found else int(element.get("index", order))
        rt = None
        if RT in terms:
            rt = float(terms[RT].get("value", "nan"))
            rt = rt if terms[RT].get("unitAccession") == MINUTE else rt / 60
        if ms_level is None or level == ms_level:
            arrays = dict(_array(e) for e in element.iter() if _name(e) == "binaryDataArray") if peaks else {}
            precursor = float(terms[SELECTED_MZ].get("value", "nan")) if SELECTED_MZ in terms else None
            yield os.path.basename(path), order, scan, level, rt, arrays.get("mz", np.zeros(0)).tolist(), arrays.get("intensity", np.zeros(0)).tolist(), precursor, last_ms1 if level > 1 else None
        if level == 1:
            last_ms1 = scan
        order += 1
        element.clear()


class MzmlSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mzml"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return MzmlReader(self.options)


class MzmlReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].removeprefix("file://")
        self.level = int(options["ms_level"]) if options.get("ms_level") else None
        self.peaks = options.get("peaks", "true").lower() != "false"

    def partitions(self) -> list[InputPartition]:
        if os.path.isdir(self.path):
            files = sorted(glob.glob(os.path.join(self.path, "*.mzML")))
        else:
            files = sorted(glob.glob(self.path))
        return [InputPartition(f) for f in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return spectra(partition.value, self.level, self.peaks)


def read_mzml(spark: SparkSession, path: str, ms_level: int | None = None, peaks: bool = True) -> DataFrame:
    spark.dataSource.register(MzmlSource)
    reader = spark.read.format("mzml").option("peaks", str(peaks).lower())
    if ms_level is not None:
        reader = reader.option("ms_level", ms_level)
    return reader.load(path)


def with_ms1(df: DataFrame) -> DataFrame:
    """MS2 spectra with ms1 = struct(mz, intensity) of the MS1 spectrum before them; peaks are joined once, by scan."""
    ms1 = df.where("ms_level = 1").select("file", F.col("scan").alias("ms1_scan"), F.struct("mz", "intensity").alias("ms1"))
    return df.where("ms_level = 2").join(ms1, ["file", "ms1_scan"], "left")


def carried_ms1(df: DataFrame, by: str = "file", order: str = "ord") -> DataFrame:
    """`ms1_scan` for a table that lacks it: the last MS1 scan before each row."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("ms1_scan", F.last(F.when(F.col("ms_level") == 1, F.col("scan")), ignorenulls=True).over(w))
