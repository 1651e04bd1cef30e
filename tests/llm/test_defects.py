from quern.llm.defects import EXAMPLES, Field, Model, clauses, defect, defective_answers, empty, fit
from quern.runtime import table

SCHEMA = "id bigint, standard_question string, similar_questions array<string>, answers array<string>, updated_at timestamp_ntz, extra string"


def test_empty():
    assert all(map(empty, [None, "", "  \n", "​", "n/a", "N/A", "null", "<br/>", "<p>&nbsp;</p>", "—", "...", "[]"]))
    assert not any(map(empty, ["No.", "29 days", "不可以。", "0"]))


def test_clauses():
    assert [c for c, _ in clauses("It depends. Ask Nr. 7 now!\n- one\n- two")] == ["It depends.", "Ask Nr. 7 now!", "- one", "- two"]


def test_field_learns_a_sequence_rule():
    import numpy as np

    x = [np.array([[1, 0], [0, 1.0]])] * 20 + [np.array([[0, 1.0]])] * 20
    y = [np.array([0, 1])] * 20 + [np.array([1])] * 20
    f = Field(2, 2).fit(x, y)
    assert [t.tolist() for t in f.decode(x[:1] + x[-1:])] == [[0, 1], [1]]


def test_found(spark, sf):
    import datetime as dt

    base = table(spark, sf, "faq_entries")
    q = "How long does Velora Union need in Wesford to settle the cash value table with Jovan Polum Travel Cover if the form was not signed?"
    good = "The billing unit reviews the premium receipt before the next due date. The customer receives a short message."
    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, q, [], [good, None, "", "I'm sorry, but I can't answer this question.", q, q.rstrip("?"), f"{q} {good}", f"{q} I don't know.", "La oficina de contratos limita el valor de rescate antes del próximo vencimiento.", "The billing unit reviews the premium receipt bef", "29 days", "No."], t, "x"),
        (2, q, None, None, t, None),
        (3, None, None, [], None, None),
        (4, None, None, ["I cannot help with this request."], None, None),
        (5, q, [], [good], t, None),
        (5, q, [], ["I don't know."], t + dt.timedelta(1), None),
        (5, q, [], ["I don't know."], t + dt.timedelta(1), None),
        (None, q, [], [None], t, None),
    ]
    mine = spark.createDataFrame(rows, SCHEMA)
    far = base.select((base.id + 1000).alias("id"), "standard_question", "similar_questions", "answers", "updated_at", base.tag_name.alias("extra"))
    found = {(r.id, r.answer_no): r.defect for r in defective_answers(mine.unionByName(far)).where("id < 1000 or id is null").collect()}
    assert found == {
        (1, 2): "empty", (1, 3): "empty", (1, 4): "refusal", (1, 5): "copied_question", (1, 6): "copied_question", (1, 8): "refusal", (1, 9): "other_language", (1, 10): "truncated",
        (2, 0): "empty", (3, 0): "empty", (4, 1): "refusal", (5, 1): "refusal",
    }
    assert defective_answers(mine.limit(0)).count() == 0


def test_held_out_accuracy(spark, sf):
    """On answers broken on purpose that the field wasn't fitted on."""
    base = table(spark, sf.replace("0.001", "0.01"), "faq_entries")
    model: Model = fit(base, 600)
    rows = [r for r in base.where("id > 1500").dropDuplicates(["id"]).collect() if r.answers]
    good = [(r.standard_question, a) for r in rows for a in r.answers if a and a.endswith(("units.", "jours.", "Taler.", "unidades.", "after two written reminders.")) and len(a) > 80][:100]
    assert len(good) > 30
    tag = lambda q, a: defect(*model.tags([(model.reader.entry([q]), a)])[0])
    assert sum(tag(q, a) is None for q, a in good) >= 0.95 * len(good)
    assert sum(tag(q, a[: -len(clauses(a)[-1][0]) // 2].rstrip()) == "truncated" for q, a in good) >= 0.9 * len(good)
    assert sum(tag(q, q) == "copied_question" for q, a in good) >= 0.95 * len(good)
    assert sum(tag(q, "作为智能助手，我无法回答这个问题。" if "，" in q else "I don't know; try asking another way.") == "refusal" for q, a in good) >= 0.95 * len(good)


# Wordings that stand in no list and none of the rows the field is fitted on.
REFUSALS = {
    "How long does the insurer need to settle the hospital daily allowance with my contract?": ["No comment.", "We have no details on this matter.", "Unable to provide a response.", "I would prefer not to get into that.", "There is nothing I can tell you about this.", "That's not something I can discuss.", "My apologies, I lack the information to reply.", "I'm afraid I have no idea.", "This question cannot be answered by me."],
    "Wie lange braucht der Versicherer, um die Todesfallleistung mit meinem Vertrag abzurechnen?": ["Dazu gebe ich keine Antwort.", "Leider fehlen mir die Angaben, ich weiß es nicht.", "Wir können Ihnen hierbei nicht helfen."],
    "Combien de temps faut-il pour régler le capital décès avec mon contrat si le traitement a eu lieu ici ?": ["Aucune idée.", "Nous ne pouvons pas vous renseigner.", "Je ne dispose d'aucune réponse."],
    "¿Cuánto tarda la aseguradora en liquidar la suma asegurada de mi contrato si la empresa cierra?": ["Ni idea.", "No podemos dar ninguna respuesta.", "No tengo conocimiento de ello."],
    "保险公司处理我的住院津贴要多久？": ["恕难奉告。", "我们无法提供这方面的资料。", "我不知道答案。"],
}
ANSWERS = ["No.", "29 days", "We cannot pay for treatment in Wesford without receipt ZD-6716, but the rider covers the rest.", "Unfortunately the claim expires after 154 days; send form PU-5404 before.", "No, the rider must be requested in writing.", "Sorry for the delay: Ulmdelari Foundry pays 1,645 units within 232 days.", "The insurer checks the list of excluded treatments if a second opinion contradicts the first; no fee is charged for this step."]
OTHER = ["Ubezpieczyciel wypłaca świadczenie w ciągu trzydziestu dni od otrzymania dokumentów.", "Страховая компания выплачивает пособие в течение тридцати дней.", "De verzekeraar betaalt de uitkering binnen dertig dagen na ontvangst van de stukken.", "保险公司在三十天内支付住院津贴。"]


def test_unseen_wordings(spark, sf):
    """Refusals and languages that the field has never met."""
    model = fit(table(spark, sf.replace("0.001", "0.01"), "faq_entries"), 600)
    tag = lambda q, a: defect(*model.tags([(model.reader.entry([q]), a)])[0])
    got = [(a, tag(q, a)) for q, texts in REFUSALS.items() for a in texts]
    assert all(any(core in a for _, cores, _ in EXAMPLES.values() for core in cores) is False for a, _ in got)
    assert sum(d == "refusal" for _, d in got) >= 0.9 * len(got), [g for g in got if g[1] != "refusal"]
    q = next(iter(REFUSALS))
    assert [a for a in ANSWERS if tag(q, a)] == []
    assert [a for a in OTHER if tag(q, a) != "other_language"] == []


def test_statistics_cover_all_entries(spark, sf):
    """Only the field is fitted on the sample: what is counted is the same for any."""
    base = table(spark, sf, "faq_entries")
    a, b = fit(base, 20).reader, fit(base, 200).reader
    assert a.complete and a.complete == b.complete
    assert a.languages.row == b.languages.row and (a.languages.score == b.languages.score).all()
    # repeated rows count once
    c = fit(base.unionAll(base), 20).reader
    assert c.complete == a.complete and (c.languages.score == a.languages.score).all()
