"""The 15-row golden customer table and its expected outputs (fixed values).

Values are test data (FIXTURES.md §1); expected tables are the published
cleaned / masked results, 14 rows each, at as_of = 2026-02-27.
"""

HEADER = ("customer_id,first_name,last_name,email,phone,date_of_birth,address,income,"
          "account_status,created_date")

RAW_CSV = HEADER + """
1,John,Doe,john.doe@gmail.com,555-123-4567,1985-03-15,123 Main St New York NY 10001,75000,active,2024-01-10
2,Jane,Smith,jane.smith@company.com,(555) 987-6543,1990-07-22,456 Oak Ave Los Angeles CA 90001,95000,active,2024-01-11
3,,Johnson,bob.johnson@email.com,(555) 234-5678,1988-11-08,789 Cedar Blvd Brooklyn NY 11201,,suspended,2024-01-12
4,Mary,Brown,mary.brown@gmail.com,555-345-6789,01/15/1975,321 Pine Rd Chicago IL 60601,120000,,2024-01-13
5,Robert,,robert.wilson@yahoo.com,555-456-7890,2005-12-25,892 Elm St Houston TX 77001,55000,active,2027-06-01
6,PATRICIA,Davis,patricia.davis@gmail.com,555-567-8901,invalid_date,101 Birch Ln Phoenix AZ 85001,82000,active,2024-01-16
7,Michael,Miller,michael.miller@work.com,555.678.9012,1992-02-14,111 Maple Dr Philadelphia PA 19101,98000,active,2024-01-17
8,Sarah,wilson,sarah.wilson@gmail.com,5557890123,1968-06-18,121 Cedar Way San Antonio TX 78201,105000,inactive,2024-01-18
9,David,Moore,david.moore@hotmail.com,+1-555-789-0123,1958-09-30,,110000,active,2024-01-19
10,jennifer,Taylor,jennifer.taylor@company.net,555-890-1234,1970-03-05,131 Spruce St San Diego CA 92101,88000,unknown,2024-01-20
11,Thomas,White,thomas.white@gmail.com,555-901-2345,invalid_date,212 Willow Ct Dallas TX 75201,-5000,active,2024-01-21
12,Amanda,Harris,amanda.harris@company.com,(555) 012-3456,1850-01-01,321 Birch Blvd Miami FL 33101,65000,active,2024-01-22
13,Christopher,Martin,christopher.martin@gmail.com,555-123-9876,1980-05-20,,15000000,suspended,2024-01-23
14,Jessica,Robinson,jessica.robinson@email.com,555-234-8765,,301 Elm Ave Boston MA 02101,72000,active,2024-01-24
1,Daniel,Anderson,daniel.anderson@yahoo.com,555-345-7654,1978-08-12,401 Oak St Seattle WA 98101,93000,active,2024-01-25
"""

CLEANED_CSV = HEADER + """
1,John,Doe,john.doe@gmail.com,555-123-4567,1985-03-15,123 Main St New York NY 10001,75000,active,2024-01-10
2,Jane,Smith,jane.smith@company.com,555-987-6543,1990-07-22,456 Oak Ave Los Angeles CA 90001,95000,active,2024-01-11
3,[UNKNOWN],Johnson,bob.johnson@email.com,555-234-5678,1988-11-08,789 Cedar Blvd Brooklyn NY 11201,0,suspended,2024-01-12
4,Mary,Brown,mary.brown@gmail.com,555-345-6789,1975-01-15,321 Pine Rd Chicago IL 60601,120000,unknown,2024-01-13
5,Robert,[UNKNOWN],robert.wilson@yahoo.com,555-456-7890,2005-12-25,892 Elm St Houston TX 77001,55000,active,2027-06-01
6,Patricia,Davis,patricia.davis@gmail.com,555-567-8901,,101 Birch Ln Phoenix AZ 85001,82000,active,2024-01-16
7,Michael,Miller,michael.miller@work.com,555-678-9012,1992-02-14,111 Maple Dr Philadelphia PA 19101,98000,active,2024-01-17
8,Sarah,Wilson,sarah.wilson@gmail.com,555-789-0123,1968-06-18,121 Cedar Way San Antonio TX 78201,105000,inactive,2024-01-18
9,David,Moore,david.moore@hotmail.com,555-789-0123,1958-09-30,[UNKNOWN],110000,active,2024-01-19
10,Jennifer,Taylor,jennifer.taylor@company.net,555-890-1234,1970-03-05,131 Spruce St San Diego CA 92101,88000,unknown,2024-01-20
11,Thomas,White,thomas.white@gmail.com,555-901-2345,,212 Willow Ct Dallas TX 75201,0,active,2024-01-21
12,Amanda,Harris,amanda.harris@company.com,555-012-3456,,321 Birch Blvd Miami FL 33101,65000,active,2024-01-22
13,Christopher,Martin,christopher.martin@gmail.com,555-123-9876,1980-05-20,[UNKNOWN],15000000,suspended,2024-01-23
14,Jessica,Robinson,jessica.robinson@email.com,555-234-8765,,301 Elm Ave Boston MA 02101,72000,active,2024-01-24
"""

MASKED_CSV = HEADER + """
1,J***,D***,j***@gmail.com,***-***-4567,1985-**-**,[MASKED ADDRESS],75000,active,2024-01-10
2,J***,S***,j***@company.com,***-***-6543,1990-**-**,[MASKED ADDRESS],95000,active,2024-01-11
3,[UNKNOWN],J***,b***@email.com,***-***-5678,1988-**-**,[MASKED ADDRESS],0,suspended,2024-01-12
4,M***,B***,m***@gmail.com,***-***-6789,1975-**-**,[MASKED ADDRESS],120000,unknown,2024-01-13
5,R***,[UNKNOWN],r***@yahoo.com,***-***-7890,2005-**-**,[MASKED ADDRESS],55000,active,2027-06-01
6,P***,D***,p***@gmail.com,***-***-8901,,[MASKED ADDRESS],82000,active,2024-01-16
7,M***,M***,m***@work.com,***-***-9012,1992-**-**,[MASKED ADDRESS],98000,active,2024-01-17
8,S***,W***,s***@gmail.com,***-***-0123,1968-**-**,[MASKED ADDRESS],105000,inactive,2024-01-18
9,D***,M***,d***@hotmail.com,***-***-0123,1958-**-**,[UNKNOWN],110000,active,2024-01-19
10,J***,T***,j***@company.net,***-***-1234,1970-**-**,[MASKED ADDRESS],88000,unknown,2024-01-20
11,T***,W***,t***@gmail.com,***-***-2345,,[MASKED ADDRESS],0,active,2024-01-21
12,A***,H***,a***@company.com,***-***-3456,,[MASKED ADDRESS],65000,active,2024-01-22
13,C***,M***,c***@gmail.com,***-***-9876,1980-**-**,[UNKNOWN],15000000,suspended,2024-01-23
14,J***,R***,j***@email.com,***-***-8765,,[MASKED ADDRESS],72000,active,2024-01-24
"""


def rows(csv_text: str) -> list[tuple]:
    import csv
    import io

    r = list(csv.reader(io.StringIO(csv_text.strip())))
    return [tuple(v if v != "" else None for v in row) for row in r[1:]]
