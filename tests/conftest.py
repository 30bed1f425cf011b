import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="clinilake-tests-")
    s = (SparkSession.builder.master("local[*]").appName("clinilake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from clinilake import session
    session.checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted tuples of the given columns (all if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plan_text(df, section="physical"):
    """One section of ``df.explain("extended")``: parsed, analyzed,
    optimized or physical (the public way to read a plan)."""
    import contextlib
    import io
    import re
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    parts = re.split(r"^== (.+?) ==$", buf.getvalue(), flags=re.M)
    sections = {parts[i].split()[0].lower(): parts[i + 1] for i in range(1, len(parts) - 1, 2)}
    return sections[section]
