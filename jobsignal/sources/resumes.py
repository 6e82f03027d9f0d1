"""Resume texts as a table: file_path, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.functions.rules import is_pdf
from jobsignal.schema import STORED_RESUME, STORED_USER


def read_resume_texts(spark: SparkSession, root: str) -> DataFrame:
    """Extracted texts, one file per resume, named after the uploaded file."""
    texts = spark.read.text(root, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("value").alias("text"))


def accepted_uploads(uploads: DataFrame, name: str = "file_name") -> DataFrame:
    """Uploads with the only file type that is accepted."""
    return uploads.where(is_pdf(F.col(name)))


def read_stored_resumes(spark: SparkSession, path: str) -> DataFrame:
    """Resume documents that an earlier release kept as JSON, one object per file."""
    return spark.read.schema(STORED_RESUME).option("multiLine", True).json(path)


def read_stored_users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_USER).option("multiLine", True).json(path)
