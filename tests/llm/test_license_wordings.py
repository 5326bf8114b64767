import pytest

from tests.llm import cases
from tidemark.llm.licenses import licenses

# Text, and the labels of its detections.
WORDINGS = {
    "GNU General Public License v3": "gpl,gpl-3.0",
    "GNU General Public License v2.0 or later": "gpl,gpl-2.0",
    "the GNU General Public License as published by the Free Software Foundation; either version 2": "gpl,gpl-2.0",
    "version 2.1 of the GNU Lesser General Public License": "lgpl-2.1",
    "GNU Affero General Public License v3.0": "agpl-3.0",
    "Apache License v2.0": "apache,apache-2.0",
    "Apache-2.0": "apache-2.0",
    "Apache 2 license": "apache-2.0",
    "BSD 3-Clause License": "bsd-3-clause",
    "BSD Two Clause License": "bsd-2-clause",
    "BSD Zero Clause License": "0bsd",
    "3-Clause BSD": "bsd-3-clause",
    "GPLv3": "gpl-3.0",
    "GNU GPL v2": "gpl-2.0",
    "LGPL-2.1": "lgpl-2.1",
    "AGPL": "agpl",
    "MPL 2.0": "mpl-2.0",
    "MS-PL": "ms-pl",
    "Licensed under the GPL v3": "gpl-3.0",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa-4.0",
    "Creative Commons Attribution-Noncommercial-Share Alike 3.0": "cc-by-nc-sa",
    "Creative Commons Attribution-No Derivative Works 3.0": "cc-by-nd",
    "Creative Commons Attribution License 4.0": "cc-by-4.0",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa-4.0",
    "Server: Apache/2.0.55, a simple example of items, deployed asleep": "",
}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(WORDINGS)]
    return {r.doc_id: r.labels for r in licenses(cases.frame(spark, rows)).collect()}


@pytest.mark.parametrize("text", WORDINGS)
def test_wording(labels, text):
    assert labels[list(WORDINGS).index(text)] == WORDINGS[text]
