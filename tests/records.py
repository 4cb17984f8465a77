"""Record XML for tests."""

HEAD = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE PubmedArticleSet>\n<PubmedArticleSet>\n'
TAIL = "<DeleteCitation><PMID>9</PMID></DeleteCitation></PubmedArticleSet>\n"


def record(
    pmid='<PMID Version="1">1</PMID>',
    title="",
    abstract="",
    date="",
    journal="",
    article="",
    citation="",
    data="",
) -> str:
    return (
        f"<PubmedArticle><MedlineCitation>{pmid}<Article><Journal><JournalIssue><PubDate>{date}"
        f"</PubDate></JournalIssue>{journal}</Journal>{title}{abstract}{article}</Article>"
        f"{citation}</MedlineCitation><PubmedData>{data}</PubmedData></PubmedArticle>"
    )


def bulk(*records: str) -> str:
    return HEAD + "\n".join(records) + TAIL
