"""A reader for tests: the file's name is its text; a name that begins with y fails."""


def read(doc, content):
    if content.startswith(b"y"):
        raise RuntimeError(doc)
    return [{"idx": 0, "text": content.decode(), "bbox": [0, 0, 1, 1], "confidence": 0.5, "language": "eng", "block_num": 1, "line_num": 1, "word_num": 1}]
