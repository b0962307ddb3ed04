from fieldtally.forms.activity import ACTIVITY
from fieldtally.forms.base import FormSpec, Question, Repeat
from fieldtally.forms.monitoring import MONITORING
from fieldtally.forms.rapid_coverage import RAPID_COVERAGE
from fieldtally.forms.readiness import READINESS
from fieldtally.forms.social import SOCIAL
from fieldtally.forms.target import TARGET

FORMS = {spec.name: spec for spec in (READINESS, RAPID_COVERAGE, ACTIVITY, TARGET, SOCIAL, MONITORING)}

__all__ = [
    "ACTIVITY", "FORMS", "FormSpec", "MONITORING", "Question", "RAPID_COVERAGE", "READINESS",
    "Repeat", "SOCIAL", "TARGET",
]
