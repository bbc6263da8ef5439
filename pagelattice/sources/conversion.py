"""Conversion of PDF files by a service that is plugged in; the engine itself has no converter and no network."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.operators.links import accepted_parses

#: A converter takes a file's bytes and options, and gives markdown, json (a tree), score and images (name to base64).
Converter = Callable[[bytes, dict], dict]


def convert_options(mode: str = "balanced", *, force_ocr: bool = False, max_polls: int = 1800, poll_seconds: int = 1, timeout: int = 300) -> dict:
    """What a converter is asked for: markdown and the tree, with images; force_ocr is a hint that it may ignore."""
    extra = {"force_ocr": True} if force_ocr else None
    return {"mode": mode, "output_format": "markdown,json", "disable_image_extraction": False, "additional_config": extra, "max_polls": max_polls, "poll_seconds": poll_seconds, "timeout": timeout}


def required_key(variable: str) -> str:
    """The key of a service from the environment; RuntimeError if it is not set. The key is never shown."""
    key = os.environ.get(variable, "").strip()
    if not key:
        raise RuntimeError(f"{variable} is not set")
    return key


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and content of the PDF files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder).select("path", "content")


def converted(files: DataFrame, convert: Converter, options: dict, *, threshold: float = 3.0, retries: bool = True) -> DataFrame:
    """path, forced, score, attempt, markdown, tree (JSON text), images (name to base64) of the parse that stands for each file.

    A file whose first parse has a known score below threshold is parsed again with the hint for OCR; the second parse stands if its
    score is known and no lower. Files are converted where they are read, one at a time; an error of the converter ends the job.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"]):
                for attempt in (1, 2):
                    got = convert(content, options if attempt == 1 else {**options, "additional_config": {"force_ocr": True}})
                    tree = got.get("json")
                    rows.append((path, attempt == 2, got.get("score"), attempt, got.get("markdown") or "", json.dumps({} if tree is None else tree, ensure_ascii=False), got.get("images") or {}))
                    if not retries or got.get("score") is None or got["score"] >= threshold:
                        break
            yield pd.DataFrame(rows, columns=["path", "forced", "score", "attempt", "markdown", "tree", "images"])

    attempts = files.mapInPandas(run, "path string, forced boolean, score double, attempt int, markdown string, tree string, images map<string,string>")
    return accepted_parses(attempts, "path", threshold=threshold, retries=retries).withColumn("images", F.coalesce("images", F.create_map().cast("map<string,string>")))
