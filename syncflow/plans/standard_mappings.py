"""Column mappings of the two standard objects.

Fixed values: source column, target column, SQL type (``NA``: not cast). The
type holds a comma in places, so the lines are quoted CSV.
"""

from __future__ import annotations

import csv

from syncflow.operators.reshape import ColumnMap

# Outbound account mapping.
ACCOUNT_MAPPING = """\
source,target,dtype
FirstName,FirstName,NA
LastName,LastName,NA
RecordTypeId,RecordTypeId,NA
patient_bk,Patient_BK__c,varchar(100)
VBC_Program_Name,VBC_Program__c,varchar(100)
MBI,MBI__c,varchar(100)
Primary_Nephrologist,Primary_nephrologist_from_DW__c,varchar(100)
Primary_Nephrologist_Practice,Primary_Nephrologist_practice_from_DW__c,varchar(100)
Provider_Name,Nephrologist_attributed_by_CMS__c,varchar(100)
Practice_From_AlignmentFile,CMS_attributed_nephrologist_practice__c,varchar(100)
Latest_eGFR,Latest_eGFR__c,"decimal(12,2)"
HCC_Score,HCC_score_aka_RAF_score__c,"decimal(12,4)"
2_year_dialysis_crash_score,X2_year_dialysis_crash_score__c,"decimal(12,4)"
2_year_dialysis_crash_quintile,X2_year_dialysis_crash_quintile__c,varchar(100)
No_of_hospitalizations_in_last_6_months,of_hospitalizations_in_last_6_months__c,int
Email,PersonEmail,NA
Home_Phone,PersonHomePhone,NA
Work_Phone,Phone,NA
DOB,PersonBirthdate,NA
Modality,Type_of_Dialysis__c,varchar(100)
Gender,HealthCloudGA__Gender__pc,NA
"""

# Inbound user mapping.
USER_MAPPING = """\
source,target,dtype
Alias,Alias,varchar(100)
Id,Id,varchar(100)
IsActive,IsActive,varchar(100)
LastLoginDate,LastLoginDate,bigint
UserRole_Name__c,UserRole_Name,varchar(100)
Contact_Name__c,Contact_Name,varchar(100)
Profile_Name__c,Profile_Name,varchar(100)
LastModifiedDate,LastModifiedDate,bigint
CreatedDate,CreatedDate,bigint
FirstName,FirstName,varchar(100)
LastName,LastName,varchar(100)
Username,Username,varchar(100)
Phone,Mobile,varchar(25)
LastModifiedBy_Name__c,LastModifiedBy,varchar(100)
"""


def parse_mapping(text: str) -> list[ColumnMap]:
    """Mapping lines from CSV text with a header."""
    return [
        ColumnMap(line["source"], line["target"], None if line["dtype"] == "NA" else line["dtype"])
        for line in csv.DictReader(text.splitlines())
    ]
