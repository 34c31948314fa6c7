"""Making the package known to Python workers."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_attached: set[str] = set()


def attach(spark: SparkSession) -> SparkSession:
    """Ship this package to the workers of ``spark`` once, for clusters where it isn't installed."""
    app = spark.sparkContext.applicationId
    if app not in _attached:
        root = Path(__file__).resolve().parent
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, f"{root.name}/{path.relative_to(root)}")
        target = Path(tempfile.mkdtemp(prefix="pricegrain-")) / "pricegrain.zip"
        target.write_bytes(data.getvalue())
        spark.sparkContext.addPyFile(str(target))
        _attached.add(app)
    return spark
