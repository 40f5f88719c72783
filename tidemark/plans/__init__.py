from tidemark.plans.jobs import changes_job, changes_step, reports_job
from tidemark.plans.reports import (
    annual_salary_by_department,
    career_progression,
    department_turnover,
    employee_changes,
    employee_master,
    gender_ratio,
    job_hoppers,
    manager_impact,
    salary_trends,
    senior_employees,
)

__all__ = [
    "annual_salary_by_department",
    "career_progression",
    "changes_job",
    "changes_step",
    "department_turnover",
    "employee_changes",
    "employee_master",
    "gender_ratio",
    "job_hoppers",
    "manager_impact",
    "reports_job",
    "salary_trends",
    "senior_employees",
]
