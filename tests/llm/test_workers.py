"""All operators and the pipeline on workers that do not have the package."""
from tests.test_workers import run_elsewhere

from censa.llm.queries import QUERIES


def test_queries_without_the_package_on_the_workers(tmp_path):
    run_elsewhere(tmp_path, list(QUERIES))
