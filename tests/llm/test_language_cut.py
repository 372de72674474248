"""The language stage of the pipeline drops texts of no clear language."""

import corpus_pipeline
from rolecast.llm import langid
from rolecast.llm.queries import fold

SF = "/root/testdata/sf0.01"
UNLEARNED = [
    "Wczoraj wieczorem poszliśmy do teatru, aby obejrzeć nową sztukę młodego reżysera, która wywołała wiele dyskusji wśród krytyków i widzów.",
    "Вчера вечером мы пошли в театр, чтобы посмотреть новую пьесу молодого режиссёра, которая вызвала много споров.",
    "昨日の夜、私たちは若い監督の新しい芝居を見るために劇場へ行きました。",
    "Eilen illalla menimme teatteriin katsomaan nuoren ohjaajan uutta näytelmää, joka on herättänyt paljon keskustelua.",
    "Dün akşam genç yönetmenin eleştirmenler arasında çok tartışmaya yol açan yeni oyununu izlemek için tiyatroya gittik.",
    "xqzv kjw pqrt zzxk vvbq jjkw qqzx wkpv " * 10,
]


def test_texts_of_unlearned_languages_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**9 + i, t, None, "odd", len(t)) for i, t in enumerate(UNLEARNED)], docs.schema)
    stay = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.unionByName(odd), SF).select("doc_id").collect()}
    assert not {i for i in stay if i >= 10**9}
    clean = {r["doc_id"] for r in docs.filter(fold(4) == 2).select("doc_id", "text").collect() if langid.has_letter(r["text"])}
    assert len(clean) > 200 and clean <= stay


def test_floors_follow_the_learned_languages():
    model = lambda **langs: langid.Model(families=sorted(langs), langs=langs)
    assert langid.floors(model(germanic=["de", "en"], romance=["fr"])) == {"de": 0.25, "en": 0.25, "fr": 0.5}
    assert langid.floors(model(germanic=["en"])) == {"en": 1.0} and langid.floors(langid.Model()) == {}
