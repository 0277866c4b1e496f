SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return (text or "").encode().split()
