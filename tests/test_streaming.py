import plain
import pytest
from pyspark.errors import StreamingQueryException

from martflow.operators import CheckPlan, Reference
from martflow.plans import Flow, last_run, retail_spec, volume_history
from martflow.streaming import run_new_files

CALM = CheckPlan(reference=Reference("customer_id", "customer_id"), min_history=99)


class Inbox:
    """A folder that files drop into."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "in").mkdir(parents=True)
        (folder / "people.csv").write_text("customer_id,country\nw4,PE\n")
        self.spec = retail_spec(str(folder / "in"), str(folder / "people.csv"), str(folder / "out"), checks=CALM)
        self.flow = Flow(spark, self.spec)
        self.text = ""

    def put(self, name, rows):
        (self.folder / "in" / name).write_text(plain.HEADER + rows)
        self.text += rows

    def run(self, checkpoint="checkpoint", **options):
        run_new_files(
            self.spark, self.spec, str(self.folder / "in"), str(self.folder / checkpoint), **options
        ).awaitTermination()
        return {(str(r[0]), r[1]): tuple(r)[2:] for r in self.flow.mart().collect()}

    def volumes(self):
        return [r["rows_in_batch"] for r in volume_history(self.flow.ledger()).collect()]


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def line(order, day, price=2.5, quantity=2):
    return f"{order},w4,2023-08-{day:02} 16:20:05,rope,{quantity},{price}\n"


def test_each_call_runs_the_files_that_arrived(inbox):
    inbox.put("1.csv", line("a", 19))
    assert inbox.run() == plain.mart(inbox.text)
    inbox.put("2.csv", line("a", 21, price=9.0))
    assert inbox.run() == plain.mart(inbox.text)
    assert inbox.run() == plain.mart(inbox.text)
    assert inbox.volumes() == [1, 1]


@pytest.mark.parametrize("days", [(19, 20, 21), (21, 20, 19), (20, 21, 19)])
def test_how_files_are_dealt_to_batches_makes_no_difference(spark, tmp_path, days):
    marts = []
    for at_once in (None, 1, 2):
        inbox = Inbox(spark, tmp_path / str(at_once))
        for n, day in enumerate(days):
            inbox.put(f"{n}.csv", line(f"o{n}", day) + line("same", day, price=1.0 + day))
        marts.append(inbox.run(max_files=at_once))
        assert inbox.flow.current().count() == 4
    assert marts == [plain.mart(inbox.text)] * 3


def test_a_file_that_arrives_late_counts(inbox):
    inbox.put("1.csv", line("a", 21))
    inbox.run()
    inbox.put("2.csv", line("b", 19) + "c,w4,no time,rope,1,1.0\nd,w4,2023-08-19 10:00:00,rope,0,1.0\n")
    assert inbox.run() == plain.mart(inbox.text)
    row = last_run(inbox.flow.ledger()).first()
    assert (row["rows_read"], row["rows_rejected"], row["rows_unreadable"], row["rows_in_batch"]) == (3, 2, 1, 1)
    assert row["watermark_after"] == "2023-08-21 16:20:05"


def test_files_delivered_again_change_nothing(inbox):
    inbox.put("1.csv", line("a", 21) + line("a", 20) + line("b", 19))
    inbox.run()
    assert inbox.run(checkpoint="another") == plain.mart(inbox.text)
    assert last_run(inbox.flow.ledger()).first()["status"] == "no_new_data"
    assert inbox.volumes() == [2]


def test_a_batch_that_the_ledger_knows_changes_nothing(inbox):
    inbox.put("1.csv", line("a", 19))
    assert inbox.flow.run(delivery="stream#0").status == "success"
    inbox.put("2.csv", line("b", 20))
    assert inbox.flow.run(delivery="stream#0").status == "no_new_data"
    assert inbox.flow.run(delivery="stream#1").rows_in_batch == 1


def test_a_failed_check_stops_the_stream_and_keeps_the_files_for_later(inbox):
    inbox.put("1.csv", line("a", 19))
    before = inbox.run()
    inbox.put("2.csv", line("b", 20).replace("w4", "w8"))
    with pytest.raises(StreamingQueryException):
        inbox.run()
    (inbox.folder / "people.csv").write_text("customer_id,country\nw4,PE\nw8,PE\n")
    assert inbox.run() == plain.mart(inbox.text) != before


def test_a_wrong_header_stops_the_stream(inbox):
    (inbox.folder / "in/1.csv").write_text("customer_id,order_id,order_ts,category,quantity,unit_price\nw4,a,2023-08-19 16:20:05,rope,1,1.0\n")
    with pytest.raises(StreamingQueryException, match="(?i)header"):
        inbox.run()
