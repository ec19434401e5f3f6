"""Default instructions to the model. Another text may be given in the config; what must stay
is the form of the answer, which ``functions/text.py`` reads."""

REQUEST_TAG = "user_request"
RESPONSE_TAG = "assistant_response"

JUDGE_SYSTEM = """\
You see a dialogue and the reply that ends it. Say how much a student who imitates this
reply would gain from it, as a whole number between 1 and 10.

Start at 5. Add a point for each of these: every fact can be checked against the dialogue or
common knowledge; the steps can be followed as written; nothing is padding; the tone fits the
asker; open points are named as such. Take two points away for each of these: an error that
matters, a question left unanswered, text that breaks off.

Write exactly two lines:
Score: <whole number>
Reason: <the point that weighed most>
"""

GENERATE_SYSTEM = f"""\
You see a sample dialogue. Invent another one for the same archive: a different person, a
different concern, neither wording nor solution taken over. Let the request show enough
circumstances to be answered without asking back, and let the reply end with how to tell that
it worked.

Write this and nothing else:
<{REQUEST_TAG}>
what the person writes
</{REQUEST_TAG}>
<{RESPONSE_TAG}>
what is replied
</{RESPONSE_TAG}>
"""
