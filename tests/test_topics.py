"""Topic source and sink: which options they set. No broker may run here, so a recorder stands in for Spark's reader and writer."""

from pricebasket.sources import files
from pricebasket.streaming import jobs


class Recorder:
    """Takes any chain of calls and remembers each call's name and arguments."""

    def __init__(self, calls=None):
        self.calls = [] if calls is None else calls

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *args))
            return self

        return call


class Session:
    def __init__(self):
        self.readStream = self.write = Recorder()


def options(recorder):
    return {call[1]: call[2] for call in recorder.calls if call[0] == "option"}


def test_a_topic_is_read_from_its_start_and_lost_offsets_end_the_job(spark):
    session = Session()
    jobs.kafka_source(session, "host:9092", "prices")
    assert session.readStream.calls[0] == ("format", "kafka")
    assert options(session.readStream) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "prices", "startingOffsets": "earliest", "failOnDataLoss": "true"}
    again = Session()
    jobs.kafka_source(again, "host:9092", "prices", starting="latest", fail_on_data_loss=False)
    assert options(again.readStream)["startingOffsets"] == "latest" and options(again.readStream)["failOnDataLoss"] == "false"


def test_messages_go_to_one_topic_or_to_each_row_s_own():
    for topic, expected in (("prices", {"kafka.bootstrap.servers": "host:9092", "topic": "prices"}), (None, {"kafka.bootstrap.servers": "host:9092"})):
        messages = Session()
        files.send_messages(messages, "host:9092", topic)
        assert messages.write.calls[0] == ("format", "kafka") and messages.write.calls[-1] == ("save",)
        assert options(messages.write) == expected
