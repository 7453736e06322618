import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hubloom.session import build_session, use_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    use_folder(str(tmp_path_factory.mktemp("shared")))
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="hubloom-warehouse-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(frame):
    """All rows as sorted plain tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def join_rows(frame):
    """Rows that came out of each join when the frame was computed."""
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name.endswith("JoinExec"):
            metrics = node.metrics()
            found.append(metrics.apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    frame.collect()
    visit(frame._jdf.queryExecution().executedPlan())
    return found
