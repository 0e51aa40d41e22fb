from tallyframe.llm import byte_bpe


def test_a_table_gone_does_not_lend_its_length_to_the_next():
    """A new table often stands where one that is gone stood."""
    for size in (1, 5, 2, 7, 3, 9) * 3:
        assert byte_bpe._longest({bytes(size): 0}) == size
    long = b"ab" * 100
    for ranks in ({b"a": 0, b"b": 1}, {b"a": 0, b"b": 1, b"ab": 2, b"abab": 3}):
        assert byte_bpe.merge_bytes(long, dict(ranks)) == ([0, 1] * 100 if len(ranks) == 2 else [3] * 50)
