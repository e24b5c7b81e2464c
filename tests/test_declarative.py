"""The pipeline definition registers every table; its bronze flows read the landed files."""

from fixtures import land_first
from pyspark.pipelines.flow import Flow
from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context
from pyspark.pipelines.output import MaterializedView, Output, StreamingTable

from tierloom.plans.declarative import define
from tierloom.sources.files import header_schema
from tierloom.streaming.flows import GLOBS, Layout


class Recorder(GraphElementRegistry):
    def __init__(self):
        self.outputs: dict[str, Output] = {}
        self.flows: dict[str, Flow] = {}

    def register_output(self, output):
        self.outputs[output.name] = output

    def register_flow(self, flow):
        self.flows[flow.target] = flow

    def register_sql(self, sql_text, file_path):
        raise AssertionError("no SQL is registered")


def test_definition(spark, tmp_path):
    land_first(tmp_path)
    layout = Layout(str(tmp_path / "bls"), str(tmp_path / "people"), "unused", "unused")
    schemas = {
        table: header_schema(spark, layout.productivity_raw, glob) for table, glob in GLOBS.items()
    }
    recorder = Recorder()
    with graph_element_registration_context(recorder):
        define(spark, layout, schemas)
    views = {name for name, output in recorder.outputs.items() if isinstance(output, MaterializedView)}
    assert views == {
        f"population_analytics.{name}"
        for name in ("gold_population_stats", "gold_best_year_by_series", "gold_series_population")
    }
    assert len(recorder.outputs) == len(recorder.flows) == 13
    assert all(output.comment for output in recorder.outputs.values())
    assert not any(isinstance(recorder.outputs[name], StreamingTable) for name in views)
    bronze = recorder.flows["bls.bronze_bls_data"].func()
    assert bronze.isStreaming
    assert bronze.columns == ["series_id", "year", "period", "value", "footnote_codes", "_metadata"]
